"""Typed settings of the pipeline, read from environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Config:
    bronze: str = "bronze"
    silver: str = "silver"
    labeled: str = "gold/labeled"
    embeddings: str = "gold/embeddings"
    checkpoints: str = "checkpoints"
    labeled_csv: str = ""  # where new labels are exported to, and read from where the table is missing
    dedup_mode: str = "minhash"  # within a batch; or near_index, also against all rows before; or silver_anti_join, exact
    dedup_index: str = "silver_index"
    dedup_threshold: float = 0.8
    dedup_ngram: int = 3
    incremental: str = "anti_join"  # or max_timestamp, which drops late rows for good
    chunk_max_chars: int = 700
    chunk_max_sentences: int = 6
    label_batch: int = 256
    embed_batch: int = 64
    embed_partitions: int = 0  # 0: four for each core
    judge_tries: int = 3
    judge_at_once: int = 8  # calls of a task at the same time
    judge_wait: float = 1.0  # seconds before the second try, twice that before the third
    sample_size: int = 100
    seed: int = 42
    quality_threshold: float = 3.5

    @staticmethod
    def of(env: Mapping[str, str] | None = None, prefix: str = "CORPUSMILL_") -> Config:
        """Settings named PREFIX + FIELD in capitals; a value of the wrong kind raises."""
        env = os.environ if env is None else env
        kinds = {"int": int, "float": float, "str": str}
        given = {f.name: kinds[str(f.type)](env[prefix + f.name.upper()]) for f in fields(Config) if prefix + f.name.upper() in env}
        return Config(**given)
