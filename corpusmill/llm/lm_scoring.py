"""Masked pseudo-likelihood scores from a bidirectional window network.

Words are hashed into buckets and counted over all documents. The commonest buckets are classes
of their own, the rest share classes; a word's share of its class comes from the counts. Classes
are numbered by rank, and the network predicts a masked word's class digit by digit (a three-level
softmax) from the classes of the SIDE words to its left and to its right. Every word of every
document is masked once while training and once while scoring.

What the corpus holds beyond that grows with it and stays partitioned: how often each word stands
between the same two neighbours. Every chunk of documents counts its words between their neighbours
and sends these counts, one for each different key, to the parts that add them up; the corpus's
counts of the chunk's keys come back. There they are, less the occurrence that is scored, mixed into
the network's probability by the weight of their evidence. A document's score is the sum of the
conditional log-probabilities of all its words. However common a pair of neighbours is, a chunk sends
no more than 2^WORD_BITS counts for it.

Training runs where the data is: in each round every task starts from the same weights,
learns from the documents of its part that are dealt to the round, and the weights are averaged
by positions seen. Counts and averages are sums of integers, so that reruns over the same splits
agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from corpusmill.llm.common import block_rows, chunks, mix, stash_buckets, sum_blocks, table, token_runs, utf8

DIGIT = 16
CLASSES = DIGIT**3
BUCKET_BITS = 20
OWN = 3072  # commonest buckets with a class of their own; the others share the rest
EDGE = CLASSES  # stands beyond a text's ends
SIDE = 2
EMBED = 8
HIDDEN = 16
ROUNDS = 2  # each document is learnt in one of them
BATCH = 1024
RATE = 0.05
SEED = 11
EVIDENCE = 4  # occurrences of a pair of neighbours at which memory and network weigh the same
TASK_WORDS = 1 << 25  # that a task learns from, or fewer, as the tasks that wrote the chunks had
PART_BYTES = 4 << 20  # of keys that a task counts at once
KEY_BYTES = 5
WORD_BITS = 13  # of a key; the others stand for the neighbours
_UNIT = 1 << 24  # weights travel as multiples of 1 / _UNIT
_PER = 256  # positions that count one in the average
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LEFT, _RIGHT, _OUTSIDE = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))

_KIND = np.full(256, 2, np.uint8)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[[*range(9, 14), 32]] = 0

_SHAPES = [(CLASSES + 1, EMBED), (2 * SIDE * EMBED, HIDDEN), (HIDDEN,), (HIDDEN, 3 * DIGIT), (1, DIGIT), (DIGIT, DIGIT), (DIGIT**2, DIGIT)]
_SIZES = [int(np.prod(s)) for s in _SHAPES]


_ZIP = "zstd"  # of the packed arrays


def _pack(*arrays: np.ndarray) -> pa.Array:
    """Compressed bytes of the arrays, one value each, before them the number of bytes."""
    return pa.array([len(x).to_bytes(8, "little") + pa.compress(x, _ZIP, asbytes=True) for x in (y.tobytes() for y in arrays)], pa.binary())


def _open(value: pa.Scalar, kind: str) -> np.ndarray:
    data = value.as_buffer()
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8].to_pybytes(), "little"), _ZIP), kind)


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """The numbers in as few bytes each as the largest needs: 1, 2, 4 or 8."""
    return numbers.astype(np.min_scalar_type(int(numbers.max())))


def _widen(value: pa.Scalar, n: int) -> np.ndarray:
    """What `_pack` made of n numbers of `_narrow`."""
    width = int.from_bytes(value.as_buffer()[:8].to_pybytes(), "little") // n
    return _open(value, f"<u{width}").astype(np.int64)


def _short(numbers: np.ndarray, width: int) -> np.ndarray:
    """The lower `width` bytes of each number."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _long(data: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = data.reshape(-1, width)
    return out.view("<u8")[:, 0]


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenize(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Chunks of documents, written in buckets by chunk: (chunk, rows, n, words, places, ends).

    rows holds the columns `carry` of the chunk's documents, words the 48-bit hashes of its distinct
    words, places the n words of the documents as places in these, and ends the offsets of the
    documents into the places.
    """
    docs = docs.select(F.struct(*carry).alias("row"), "text")
    out = StructType().add("chunk", "long").add("rows", ArrayType(docs.schema["row"].dataType))
    out = out.add("n", "long").add("words", "binary").add("places", "binary").add("ends", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            raw, offs = utf8(batch.column("text"))
            for a, b in chunks(offs, 1 << 22):
                part = offs[a : b + 1]
                found = [token_runs(raw[x[0] : x[-1]], x - x[0], _KIND)[::3] for x in (part[i : j + 1] for i, j in chunks(part, 1 << 19))]
                h = np.concatenate([x for x, _ in found])
                ends = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x) for _, x in found]))])
                words, places = np.unique(h >> np.uint64(16), return_inverse=True)
                packed = (_pack(x) for x in (_short(words, 6), places.astype("<u4" if len(words) > 0xFFFF else "<u2"), ends.astype(np.int64)))
                rows = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), batch.column("row").slice(a, b - a))
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), rows, pa.array([len(h)]), *packed], out.names)
                chunk += 1

    return stash_buckets(docs.mapInArrow(run, out), "lm_tokens", "chunk", _buckets(docs.sparkSession))


_PACKED = ["words", "places", "ends"]


def _unpack(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Word hashes, places and document offsets of each chunk."""
    for words, places, ends in zip(*(batch.column(c) for c in _PACKED), strict=True):
        words = _long(_open(words, "u1"), 6)
        yield words, _open(places, "<u4" if len(words) > 0xFFFF else "<u2"), _open(ends, "<i8")


def _bucket(words: np.ndarray) -> np.ndarray:
    return (mix(words * _ODD) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def count_words(tokens: DataFrame) -> np.ndarray:
    """Occurrences of each bucket over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for words, places, _ in _unpack(batch):
                np.add.at(total, _bucket(words), np.bincount(places, minlength=len(words)))
        yield from block_rows(total)

    return sum_blocks(tokens.select(*_PACKED).mapInArrow(run, "block int, sums binary"), 1 << BUCKET_BITS)


@dataclass(frozen=True)
class Vocabulary:
    """Class of each bucket, its log-share of the class's words, and the counts of all classes."""

    of_bucket: np.ndarray
    share: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, own: int = OWN) -> Vocabulary:
        n = len(counts)
        classes = own + np.arange(n) % (CLASSES - own)
        top = np.lexsort((np.arange(n), -counts))[:own]
        classes[top] = np.arange(len(top))
        c = counts.astype(np.float64) + 0.5  # a bucket without a count can still be scored
        total = np.bincount(classes, c, CLASSES)
        return Vocabulary(classes.astype(np.uint16), np.log(c / total[classes]).astype(np.float32), total)


def _contexts(c: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Classes of the words around each word, EDGE outside its text."""
    out = np.full((len(c), 2 * SIDE), EDGE, np.uint16)
    for k in range(1, SIDE + 1):
        out[k:, SIDE - k], out[:-k, SIDE - 1 + k] = c[:-k], c[k:]
        for i in range(k):  # the k words at either end of a text have no word that far away
            out[np.minimum(ends[:-1] + i, ends[1:] - 1)[np.diff(ends) > 0], SIDE - k] = EDGE
            out[np.maximum(ends[1:] - 1 - i, ends[:-1])[np.diff(ends) > 0], SIDE - 1 + k] = EDGE
    return out


def start_weights(vocabulary: Vocabulary) -> list[np.ndarray]:
    """Random but for the last three, with which the network gives each class its frequency."""
    rng = np.random.default_rng(SEED)
    n = vocabulary.counts + 1e-3
    levels = [n.reshape(-1, DIGIT, DIGIT**2).sum(axis=2), n.reshape(DIGIT, DIGIT, DIGIT).sum(axis=2), n.reshape(-1, DIGIT)]
    return [
        rng.normal(0, 0.3, _SHAPES[0]).astype(np.float32),
        rng.normal(0, _SHAPES[1][0] ** -0.5, _SHAPES[1]).astype(np.float32),
        np.zeros(_SHAPES[2], np.float32),
        rng.normal(0, 0.1 * HIDDEN**-0.5, _SHAPES[3]).astype(np.float32),
        *(np.log(x / x.sum(axis=1, keepdims=True)).astype(np.float32) for x in levels),
    ]


#: Sums each level's 16 numbers, as a matrix product.
_LEVELS = np.kron(np.eye(3), np.ones((DIGIT, 1))).astype(np.float32)


def _forward(w: list[np.ndarray], ctx: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, hidden units, each level's probabilities at y's place, and where y's digits are in these."""
    x = w[0].take(ctx.astype(np.int64), axis=0).reshape(len(ctx), -1)
    h = np.tanh(x @ w[1] + w[2])
    z = h @ w[3]
    z[:, :DIGIT] += w[4]
    z[:, DIGIT : 2 * DIGIT] += w[5].take(y >> 8, axis=0)
    z[:, 2 * DIGIT :] += w[6].take(y >> 4, axis=0)
    np.exp(np.clip(z, -40, 40, out=z), out=z)
    z *= np.repeat(1 / (z @ _LEVELS.astype(z.dtype)), DIGIT, axis=1)
    place = np.arange(len(y))[:, None] * 3 * DIGIT + np.stack([y >> 8, (y >> 4 & 15) + DIGIT, (y & 15) + 2 * DIGIT], axis=1)
    return x, h, z, place


def _grouped(rows: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys that occur, and the sum of the rows of each."""
    order = np.argsort(key, kind="stable")
    key = key.take(order)
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[at], np.add.reduceat(rows.take(order, axis=0), at, axis=0)


class Adagrad:
    def __init__(self, w: list[np.ndarray]):
        self.w, self.squares = [x.copy() for x in w], [np.full_like(x, 1e-8) for x in w]

    def gradients(self, ctx: np.ndarray, y: np.ndarray) -> list[tuple]:
        """(rows, gradients) of each weight array, for the mean loss."""
        w, n, every = self.w, len(y), slice(None)
        x, h, p, place = _forward(w, ctx, y)
        p.ravel()[place] -= 1
        p /= n
        back = (p @ w[3].T) * (1 - h * h)
        into = (back @ w[1].T).reshape(-1, EMBED)
        return [
            _grouped(into, ctx.ravel()),
            (every, x.T @ back),
            (every, back.sum(axis=0)),
            (every, h.T @ p),
            (every, p[:, :DIGIT].sum(axis=0)[None, :]),
            _grouped(p[:, DIGIT : 2 * DIGIT], y >> 8),
            _grouped(p[:, 2 * DIGIT :], y >> 4),
        ]

    def step(self, ctx: np.ndarray, y: np.ndarray) -> None:
        for w, squares, (rows, g) in zip(self.w, self.squares, self.gradients(ctx, y), strict=True):
            total = squares[rows] + g * g
            squares[rows] = total
            w[rows] -= np.float32(RATE) * g / np.sqrt(total)


def _round(tokens: DataFrame, vocabulary, weights: list[np.ndarray], number: int, rounds: int) -> list[np.ndarray]:
    sent = tokens.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen = Adagrad(sent.value), 0
        for batch in batches:
            for words, places, ends in _unpack(batch):
                n = np.diff(ends)
                n = n[n > 0]
                if len(n) == 0:
                    continue
                text = mix(np.add.reduceat(words[places], np.cumsum(n) - n))  # deals equal texts to one round
                mine = text % np.uint64(rounds) == number
                c = vocabulary.value.of_bucket[_bucket(words)][places[np.repeat(mine, n)]]
                ctx = _contexts(c, np.concatenate([[0], np.cumsum(n[mine])]))
                for i in range(0, len(c), BATCH):
                    net.step(ctx[i : i + BATCH], c[i : i + BATCH].astype(np.int64))
                seen += len(c)
        share = -(-seen // _PER)
        flat = np.concatenate([x.ravel() for x in net.w]).astype(np.float64)
        yield from block_rows(np.append(np.rint(np.clip(flat, -64, 64) * _UNIT).astype(np.int64) * share, share))

    total = sum_blocks(tokens.select(*_PACKED).mapInArrow(run, "block int, sums binary"), sum(_SIZES) + 1)
    sent.destroy()
    if total[-1] == 0:
        return weights
    flat = (total[:-1] / total[-1] / _UNIT).astype(np.float32)
    cuts = np.cumsum(_SIZES)[:-1]
    return [x.reshape(s) for x, s in zip(np.split(flat, cuts), _SHAPES, strict=True)]


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    weights: list[np.ndarray]

    def log_probs(self, c: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log P(class | words on both sides) of each word."""
        ctx = _contexts(c, ends)
        out = np.empty(len(c))
        for i in range(0, len(c), 2048):
            _, _, p, place = _forward(self.weights, ctx[i : i + 2048], c[i : i + 2048].astype(np.int64))
            out[i : i + 2048] = np.log(p.ravel()[place]).sum(axis=1)
        return out


def train(tokens: DataFrame, rounds: int = ROUNDS, own: int = OWN) -> Model:
    """Counts and network from all documents; without words the network stays as it starts.

    As many tasks learn as wrote the chunks: buckets make many small files, and a task that reads few of them learns little.
    """
    size = tokens.agg(F.count_distinct(F.shiftright("chunk", 32)).alias("writers"), F.sum("n").alias("words")).first()
    tokens = tokens.coalesce(max(1, size["writers"], -(-(size["words"] or 0) // TASK_WORDS)))
    vocabulary = Vocabulary.of(count_words(tokens), own)
    sent = tokens.sparkSession.sparkContext.broadcast(vocabulary)
    weights = start_weights(vocabulary)
    for r in range(rounds):
        weights = _round(tokens, sent, weights, r, rounds)
    return Model(vocabulary, weights)


def memory_keys(words: np.ndarray, places: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A key for each word between its neighbours: the lower WORD_BITS stand for the word, the others for these."""
    h = words[places]
    before, after = np.full(len(h), _OUTSIDE), np.full(len(h), _OUTSIDE)
    before[1:], after[:-1] = h[:-1], h[1:]
    full = np.diff(ends) > 0
    before[ends[:-1][full]] = after[ends[1:][full] - 1] = _OUTSIDE
    low = np.uint64((1 << WORD_BITS) - 1)
    return mix(before * _LEFT + after * _RIGHT) & ~low | (mix(words * _ODD) & low)[places]


def _parts(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that counts a key: upper bits choose it, so that the lower KEY_BYTES are enough there. Ascends with the keys."""
    return ((keys >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24)


def _send(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """(chunk, part, keys, counts): a chunk's different keys that a part counts, ascending, and how often the chunk has them."""
    for batch in batches:
        for chunk, (words, places, ends) in zip(batch.column("chunk").to_pylist(), _unpack(batch), strict=True):
            if len(places) == 0:
                continue
            keys, counts = np.unique(memory_keys(words, places, ends), return_counts=True)
            part = _parts(keys, parts)
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(keys)]
            ranges = list(zip(cuts[:-1], cuts[1:], strict=True))
            yield pa.record_batch(
                {
                    "chunk": pa.array([chunk] * len(ranges)),
                    "part": pa.array([int(part[x]) for x, _ in ranges]),
                    "keys": pa.array([_short(keys[x:y], KEY_BYTES).tobytes() for x, y in ranges], pa.binary()),
                    "counts": _pack(*(_narrow(counts[x:y]) for x, y in ranges)),
                }
            )


def _add_up(key: tuple, rows: pa.Table) -> pa.Table:
    """(chunk, part, n, counts): for each of a row's n keys how often all documents have it, then how often its neighbours have others."""
    keys = _long(np.frombuffer(b"".join(rows["keys"].to_pylist()), np.uint8), KEY_BYTES)
    ends = np.cumsum([0, *(len(x.as_buffer()) // KEY_BYTES for x in rows["keys"].combine_chunks())])
    counts = np.concatenate([_widen(x, n) for x, n in zip(rows["counts"].combine_chunks(), np.diff(ends).tolist(), strict=True)])
    every, place = np.unique(keys, return_inverse=True)
    n = np.bincount(place, counts).astype(np.int64)
    around = every >> np.uint64(WORD_BITS)
    at = np.flatnonzero(np.concatenate([[True], around[1:] != around[:-1]]))
    total = np.repeat(np.add.reduceat(n, at), np.diff(np.append(at, len(every))))
    back = (np.concatenate([n[x], total[x] - n[x]]) for x in (place[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)))
    packed = _pack(*(_narrow(x) for x in back))
    return pa.table({"chunk": rows["chunk"], "part": rows["part"], "n": pa.array(np.diff(ends), pa.int32()), "counts": packed})


def _counts_of(found: pa.Scalar, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For a chunk's n different keys, ascending: how often all documents have them, and their neighbours."""
    own, others = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x in sorted(found.values or (), key=lambda x: x["part"].as_py()):
        both = _widen(x["counts"], 2 * x["n"].as_py()).reshape(2, -1)
        own.append(both[0])
        others.append(both[1])
    own, others = np.concatenate(own), np.concatenate(others)
    assert len(own) == n, "counts of a chunk's keys are missing"
    return own, own + others


def score(docs: DataFrame, rounds: int = ROUNDS, own: int = OWN, carry: list[str] | None = None) -> DataFrame:
    """Columns of docs (or those in `carry`) with mean_log_prob, log_prob and n_tokens, under a model of all docs.

    Columns of docs with these names are replaced. A text without words (null, empty, blank)
    has 0 tokens, log_prob 0 and a null mean. Repeated rows are each other's evidence and score
    the same; equal texts have equal scores up to rounding. Long texts are read whole. No rows give
    no rows.
    """
    added = {"mean_log_prob": "double", "log_prob": "double", "n_tokens": "long"}
    tokens = tokenize(docs, [c for c in carry or docs.columns if c not in added])
    sent = docs.sparkSession.sparkContext.broadcast(train(tokens, rounds, own))
    parts = max(1, -(-(tokens.agg(F.sum("n")).first()[0] or 0) * KEY_BYTES // PART_BYTES))
    sends = "chunk long, part long, keys binary, counts binary"
    words = tokens.select("chunk", *_PACKED).mapInArrow(lambda batches: _send(batches, parts), sends)
    found = words.groupBy("part").applyInArrow(_add_up, "chunk long, part long, n int, counts binary")
    found = found.repartition(_buckets(docs.sparkSession), "chunk").groupBy("chunk").agg(F.collect_list(F.struct("part", "n", "counts")).alias("found"))
    out = StructType().add("row", tokens.schema["rows"].dataType.elementType)
    for name, kind in added.items():
        out = out.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for i, (words, places, ends) in enumerate(_unpack(batch)):
                n, total = np.diff(ends), np.zeros(len(ends) - 1)
                if len(places):
                    every, key = np.unique(memory_keys(words, places, ends), return_inverse=True)
                    own, around = _counts_of(batch.column("found")[i], len(every))
                    bucket = _bucket(words)
                    p = np.exp(model.log_probs(model.vocabulary.of_bucket[bucket][places], ends) + model.vocabulary.share[bucket][places])
                    logs = np.log((EVIDENCE * p + own[key] - 1) / (EVIDENCE + around[key] - 1))
                    total[n > 0] = np.add.reduceat(logs, ends[:-1][n > 0])
                mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
                yield pa.RecordBatch.from_arrays([batch.column("rows").slice(i, 1).flatten(), mean, pa.array(total), pa.array(n)], out.names)

    scored = tokens.select("chunk", "rows", *_PACKED).join(found, "chunk", "left").mapInArrow(run, out)
    return scored.select("row.*", *added)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), carry=["doc_id"])
