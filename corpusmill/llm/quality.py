"""Quality classifier: random-indexing word vectors, a two-layer network, calibrated scores.

Random indexing: every word bucket owns a sparse random index vector, fixed by a seed. One
pass over all documents adds to each word's context vector the index vectors of the words
beside it. The sums are integers of a fixed shape, so tasks can add theirs up in any order.
A document is the mean of its words' vectors, the mean of the products of neighbouring
words' vectors (which tells repeated words from varied ones) and its length. A two-layer network, trained with numpy on a
bounded sample of labelled documents, maps that mean to a probability, and a temperature
fitted on labelled rows kept out of training calibrates it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusmill.llm.common import block_rows, chunks, sum_blocks, table, token_runs, utf8

BUCKETS = 1 << 15
DIMS = 32
FEATURES = 2 * DIMS + 1
SHRINK = 4
BESIDE = 2  # words to each side that count as context
NONZERO = 2
SAMPLE = 20_000  # labelled rows the network is fitted on, at most
HIDDEN = 16
EPOCHS = 60
SEED = 7
ACCEPT = 0.7

#: Letters, digits and bytes of longer characters make words; runs of other signs are tokens too.
_CLASSES = np.full(256, 2, np.uint8)
_CLASSES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASSES[[*range(9, 14), 32]] = 0

_rng = np.random.default_rng(SEED)
_PLACE = _rng.integers(0, DIMS, (NONZERO, BUCKETS))
_SIGN = _rng.choice(np.array([-1, 1]), (NONZERO, BUCKETS))


def buckets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word bucket of each token, and the offsets of the rows into the tokens."""
    h, _, _, rows = token_runs(raw, offsets, _CLASSES)
    return (h >> np.uint64(64 - 15)).astype(np.int64), rows


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Context sums of all words over all documents, BUCKETS x DIMS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS * DIMS, np.int64)
        for batch in batches:
            raw, offs = utf8(batch.column(0))
            for a, b in chunks(offs):
                part = offs[a : b + 1]
                word, rows = buckets(raw[part[0] : part[-1]], part - part[0])
                doc = np.repeat(np.arange(b - a), np.diff(rows))
                for k in range(1, BESIDE + 1):
                    if len(word) <= k:
                        continue
                    same = doc[k:] == doc[:-k]
                    left, right = word[:-k][same], word[k:][same]
                    for to, of in ((left, right), (right, left)):
                        for z in range(NONZERO):
                            np.add.at(total, to * DIMS + _PLACE[z][of], _SIGN[z][of])
        yield from block_rows(total)

    return sum_blocks(docs.select("text").mapInArrow(run, "block int, sums binary"), BUCKETS * DIMS).reshape(BUCKETS, DIMS)


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Context sums as unit vectors around their mean; unseen buckets are zero."""
    v = context.astype(np.float64)
    size = np.linalg.norm(v, axis=1, keepdims=True)
    seen = size[:, 0] > 0
    v = np.divide(v, size, out=np.zeros_like(v), where=size > 0)
    if seen.any():
        v[seen] -= v[seen].mean(axis=0)
        size = np.linalg.norm(v, axis=1, keepdims=True)
        v = np.divide(v, size, out=np.zeros_like(v), where=size > 0)
    return v.astype(np.float32)


def pool(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """FEATURES numbers for each text; all zero for a text without words.

    Means are drawn towards zero by SHRINK words, so that few words say little.
    """
    raw, offs = utf8(column)
    out = np.zeros((len(column), FEATURES))
    for a, b in chunks(offs, 1 << 18):
        part = offs[a : b + 1]
        word, rows = buckets(raw[part[0] : part[-1]], part - part[0])
        n = np.diff(rows)
        full = np.flatnonzero(n)
        if len(full) == 0:
            continue
        v = vectors[word]
        both = np.zeros_like(v)
        np.multiply(v[:-1], v[1:], out=both[:-1])
        both[rows[1:][full] - 1] = 0  # a text's last word has no neighbour
        # A row's sums start where its own tokens do, so other rows don't change them.
        first, weight = rows[:-1][full], n[full, None] + SHRINK
        out[a:b][full, :DIMS] = np.add.reduceat(v, first, axis=0) / weight
        out[a:b][full, DIMS:-1] = np.add.reduceat(both, first, axis=0) / weight
        out[a:b][full, -1] = np.log(n[full])
    return out


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        # einsum adds a row's products in one order, however many rows there are; `@` doesn't.
        hidden = np.tanh(np.einsum("ij,jk->ik", (x - self.mean) / self.scale, self.w1) + self.b1)
        return np.einsum("ik,k->i", hidden, self.w2) + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.round(_sigmoid(self.logits(x.astype(np.float64)) / self.temperature), 9)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(_sigmoid(z), 1e-9, 1 - 1e-9)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def fit(vectors: np.ndarray, x: np.ndarray, y: np.ndarray, calibrate: np.ndarray) -> Model:
    """Adam on the rows outside `calibrate`; the temperature by golden section on those inside.

    Without rows the model gives 0.5 for every text.
    """
    rng = np.random.default_rng(SEED)
    x, y = x.astype(np.float64), y.astype(np.float64)
    train = ~calibrate if (~calibrate).any() else np.ones(len(y), bool)
    d = x.shape[1]
    mean = x[train].mean(axis=0) if len(y) else np.zeros(d)
    scale = x[train].std(axis=0) + 1e-6 if len(y) else np.ones(d)
    p = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1)]
    if len(y):
        p[2] = rng.normal(0, HIDDEN**-0.5, HIDDEN)
        xs, ys = (x[train] - mean) / scale, y[train]
        m, v, t = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(ys))
            for a in range(0, len(ys), 256):
                i = order[a : a + 256]
                h = np.tanh(xs[i] @ p[0] + p[1])
                e = (_sigmoid(h @ p[2] + p[3]) - ys[i]) / len(i)
                back = e[:, None] * p[2] * (1 - h * h)
                grads = [xs[i].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ e + 1e-4 * p[2], np.array([e.sum()])]
                t += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    model = Model(vectors, mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    if not calibrate.any():
        return model
    z, yc = model.logits(x[calibrate]), y[calibrate]
    lo, hi, g = -1.5, 2.5, (5**0.5 - 1) / 2  # of the temperature's natural logarithm
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if _loss(z / np.exp(a), yc) < _loss(z / np.exp(b), yc) else (a, hi)
    return Model(vectors, mean, scale, p[0], p[1], p[2], float(p[3][0]), float(np.exp((lo + hi) / 2)))


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id's text, modulo 4. Fold 2 is held out; fold 3 calibrates."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)), F.lit(2)).cast("int")


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """Word vectors over all docs; the network on at most `most` labelled rows outside fold 2.

    The sample is that with the smallest hashes of doc_id. Labels with a null doc_id or
    quality are ignored; of several labels for a doc_id the largest counts, and of several
    texts that with the least features. Texts are read whole, whatever their length. Without
    documents or labels the model gives 0.5 for every text.
    """
    vectors = word_vectors(context_vectors(docs))
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 2))
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("__quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pool(batch.column("text"), sent.value)
            rows = pa.array([r.tobytes() for r in x], pa.binary())
            names = ["doc_id", "__quality", "fold", "x"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names[:3]), rows], names)

    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most `most` short rows
    rows = (
        sample.withColumn("fold", fold(F.col("doc_id")))
        .mapInArrow(run, "doc_id long, __quality int, fold int, x binary")
        .groupBy("doc_id")
        .agg(F.max("__quality").alias("__quality"), F.max("fold").alias("fold"), F.min("x").alias("x"))
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([np.frombuffer(r["x"]) for r in rows]).reshape(-1, FEATURES)
    y = np.array([r["__quality"] for r in rows], int)
    return fit(vectors, x, y, np.array([r["fold"] == 3 for r in rows], bool))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Columns of docs with `score` and `predicted` added or replaced.

    Only the text counts. Null, empty and wordless texts share one score; equal texts,
    repeated rows among them, have equal scores. A score at ACCEPT is accepted. Other columns
    are kept as they are. No rows give no rows.
    """
    docs = docs.drop("score", "predicted")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = sent.value.scores(pool(batch.column("text"), sent.value.vectors))
            new = [pa.array(s, pa.float64()), pa.array((s >= ACCEPT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add("score", "double").add("predicted", "integer"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "score", "predicted")
