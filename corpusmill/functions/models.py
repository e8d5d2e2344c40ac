"""Models behind Arrow batches: a labeler, an embedder and a judge, with deterministic stubs.

A model is made by a factory once for each task and is kept for all its batches.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, FloatType, StringType, StructField, StructType


class Model(Protocol):
    """Answers for a batch of prompts (texts, or vectors for an embedder)."""

    def __call__(self, texts: Sequence[str]) -> list: ...


WINDOW = 16  # batches among which rows are put together by length
MOST_CHARS = 3 * 512  # of a text, for an encoder of 512 tokens
# Fixed value: the answer that stands for a batch whose model call failed.
FAILED = json.dumps({"sentiment": "neutral", "entities": [], "reason": "vllm_offline_failed"})


class StubLabeler:
    """Calls everything neutral, so that the rules decide."""

    def __call__(self, texts: Sequence[str]) -> list[str]:
        return [json.dumps({"sentiment": "neutral", "entities": [], "reason": ""}) for _ in texts]


class HashEmbedder:
    """Mean of hashed word vectors, of length one."""

    def __init__(self, dims: int = 64):
        self.dims = dims

    def __call__(self, texts: Sequence[str]) -> list[list[float]]:
        out = np.zeros((len(texts), self.dims))
        for i, text in enumerate(texts):
            for w in text.split():
                seed = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[i] += np.random.default_rng(seed).standard_normal(self.dims)
        norm = np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
        return (out / norm).astype(np.float32).tolist()


class StubJudge:
    """A score from the prompt's hash."""

    def __call__(self, texts: Sequence[str]) -> list[str]:
        out = []
        for t in texts:
            h = hashlib.blake2b(t.encode(), digest_size=2).digest()
            out.append(json.dumps({"task_completion": 1 + h[0] % 5, "hallucination": 1 + h[1] % 5, "reason": "stub"}))
        return out


def batches(frames: Iterator[pd.DataFrame], size: int, window: int, length: Callable[[pd.DataFrame], pd.Series]) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Windows of `window` batches of rows, with the rows of each batch by place, like lengths together.

    Windows go on across Arrow frames: all batches of a task but the last one are full. A window's
    rows keep their order, which the places refer to.
    """
    held: list[pd.DataFrame] = []

    def dealt(rows: pd.DataFrame) -> tuple[pd.DataFrame, list[np.ndarray]]:
        order = np.argsort(length(rows).to_numpy(), kind="stable")
        return rows, [order[i : i + size] for i in range(0, len(order), size)]

    for frame in frames:
        held.append(frame)
        n = sum(map(len, held))
        if n >= size * window:
            rows = pd.concat(held, ignore_index=True)
            whole = n - n % size
            yield dealt(rows.iloc[:whole].reset_index(drop=True))
            held = [rows.iloc[whole:]]
    rows = pd.concat(held, ignore_index=True) if held else pd.DataFrame()
    if len(rows):
        yield dealt(rows)


def _said(model: Model, texts: list[str], failed: str | None, tries: int, wait: float) -> list:
    """The model's answers to some prompts, after `tries` failures `failed` for each."""
    for attempt in range(1, tries + 1):
        try:
            said = model(texts)
            if len(said) != len(texts):
                raise ValueError(f"{len(said)} answers to {len(texts)} prompts")
            return said
        except Exception:
            if attempt == tries:
                if failed is None:
                    raise
                return [failed] * len(texts)
            time.sleep(wait * attempt)
    raise ValueError("tries must be positive")


def answer(
    df: DataFrame, prompt: str, out: str, factory: Callable[[], Model], batch: int = 256, failed: str | None = None, tries: int = 1, wait: float = 0.0, at_once: int = 0
) -> DataFrame:
    """df with the model's answer to each prompt.

    A batch whose call fails `tries` times gets `failed` for every row, or fails the task
    if that is None. Other than one answer for each prompt is a failure. The n-th new try comes
    after n times `wait` seconds. With `at_once`, a call has one prompt, which is tried again and fails alone, and a task
    makes that many calls at the same time; the model must bear that.
    """
    schema = StructType([*df.schema.fields, StructField(out, StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        call = lambda texts: _said(model, texts, failed, tries, wait)
        with ThreadPoolExecutor(max(at_once, 1)) as pool:
            for rows, parts in batches(frames, batch, WINDOW, lambda f: f[prompt].str.len().fillna(0)):
                texts = rows[prompt].fillna("")
                answers = np.empty(len(rows), object)
                for part in parts:
                    given = texts.iloc[part].tolist()
                    # map keeps the order of the prompts, whichever call ends first.
                    answers[part] = [x for said in pool.map(call, [[t] for t in given]) for x in said] if at_once else call(given)
                yield rows.assign(**{out: answers})

    return df.mapInPandas(run, schema)


def memory_error(e: Exception) -> bool:
    """Whether a failure was one of memory: Python's, or an accelerator's, which libraries raise as RuntimeError."""
    return isinstance(e, MemoryError) or isinstance(e, RuntimeError) and "out of memory" in str(e).lower()


def embed(
    df: DataFrame,
    text: str,
    out: str,
    factory: Callable[[], Model],
    batch: int = 64,
    most_chars: int = MOST_CHARS,
    small: int = 16,
    out_of_memory: Callable[[Exception], bool] = memory_error,
) -> DataFrame:
    """df with a float vector for each text, cut to most_chars first.

    A batch that fails in a way that `out_of_memory` knows is tried again in parts of `small`; other failures are raised.
    """
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(FloatType(), False))])

    def vectors_of(model: Model, texts: list[str]) -> list:
        try:
            return model(texts)
        except Exception as e:
            if not out_of_memory(e):
                raise
        return [v for j in range(0, len(texts), small) for v in model(texts[j : j + small])]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for rows, parts in batches(frames, batch, WINDOW, lambda f: f[text].str.len().fillna(0).clip(upper=most_chars)):
            texts = rows[text].fillna("").str.slice(0, most_chars)
            vectors: list = [None] * len(rows)
            for part in parts:
                for i, v in zip(part, vectors_of(model, texts.iloc[part].tolist()), strict=True):
                    vectors[i] = v
            yield rows.assign(**{out: vectors})

    return df.mapInPandas(run, schema)
