"""All pairs of alike gram sets, without a row for any candidate.

Long texts of one language share most of their n-grams, so that almost any two of them meet in some group, and candidates
written as rows outgrow the disk. Here texts lie in blocks of bits, and pairs of blocks are compared by a
Cartesian product that reads the table of blocks: nothing is shuffled or stored for a pair.

A set is a bit for each of the COMMON commonest grams of all texts, and a list of its other grams. Blocks hold texts of
one kind (a language, say) and of about one size; pairs of blocks whose counts of grams lie too far apart are
left out, since no two of their texts can be alike. Within a pair of blocks a matrix product over the commonest grams
of the two bounds what two texts share, and pairs within the bound are counted on their whole sets. Kinds and the
choice of grams cost or save time only; the result does not depend on them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from corpusmill.sources.sinks import written

COMMON = 1 << 13  # grams with a bit of their own
BLOCK = 1 << 11  # texts of a block
KINDS, SAMPLE = 8, 1000  # kinds at most, and texts from which they are taken
SLACK = 0.05  # share of a text's grams that the matrix product may leave out, about
STRIP, CHUNK = 1 << 9, 1 << 13  # texts of a matrix product with a block, and pairs counted at once
PACKING = "zstd"  # of a block's bits, which are sent to Python for each pair of blocks

INTS = ArrayType(IntegerType())


def commonest(sets: DataFrame) -> list:
    """The COMMON grams that occur in most sets."""
    kind = sets.schema["grams"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pc.value_counts(batch.column("grams").flatten())
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["gram", "n"])

    counts = sets.select("grams").mapInArrow(run, StructType().add("gram", kind).add("n", "long"))
    counts = counts.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram")
    return [r["gram"] for r in counts.limit(COMMON).collect()]


def bits_of(grams: pa.Array, common: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 0/1 matrix of sets and common grams; the place of each single gram among them, or -1, and its set."""
    at = pc.fill_null(pc.index_in(grams.flatten(), value_set=common), -1).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(grams)), grams.value_lengths().to_numpy(zero_copy_only=False))
    out = np.zeros((len(grams), COMMON), np.uint8)
    out[row[at >= 0], at[at >= 0]] = 1
    return out, at, row


def kinds_of(sample: np.ndarray) -> np.ndarray:
    """The kind of each common gram, from a 0/1 matrix of some sets.

    A set that shares less than half of its grams with any larger leader starts a kind; a gram is of the kind in which it is
    the most frequent.
    """
    x = sample[np.argsort(-sample.sum(axis=1, dtype=np.int64), kind="stable")].astype(np.float32)
    x = x[x.sum(axis=1) > 0]
    leaders: list[int] = []
    for k in range(len(x)):
        if len(leaders) < KINDS and (not leaders or (x[leaders] @ x[k]).max() < 0.5 * x[k].sum()):
            leaders.append(k)
    if len(leaders) < 2:
        return np.zeros(COMMON, np.int64)
    of = (x @ x[leaders].T).argmax(axis=1)
    share = [x[of == k].sum(axis=0) / x[of == k].sum() if (of == k).any() else np.zeros(COMMON) for k in range(len(leaders))]
    return np.argmax(share, axis=0)


def packed(sets: DataFrame, common: list, kinds: np.ndarray) -> DataFrame:
    """The sets with size, kind, counts (of grams by kind, the last for other grams), bits and rest in place of grams."""
    kind_count = int(kinds.max()) + 1
    schema = StructType([f for f in sets.schema if f.name != "grams"])
    schema = schema.add("size", "integer").add("kind", "integer").add("counts", INTS).add("bits", "binary").add("rest", sets.schema["grams"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                of = batch.schema.field("grams").type.value_type
                yield from pack(batch, pa.array(common, of))

    def pack(whole: pa.RecordBatch, common: pa.Array) -> Iterator[pa.RecordBatch]:
        for start in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(start, BLOCK)
            grams = batch.column("grams")
            rows, size = len(grams), grams.value_lengths().to_numpy(zero_copy_only=False)
            bits, at, row = bits_of(grams, common)
            of = np.where(at >= 0, kinds[at], kind_count)
            counts = np.bincount(row * (kind_count + 1) + of, minlength=rows * (kind_count + 1)).reshape(rows, -1)
            each = np.arange(rows + 1, dtype=np.int32)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[at < 0], minlength=rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(f.name) for f in schema if f.name in batch.schema.names),
                    pa.array(size, pa.int32()),
                    pa.array(counts[:, :kind_count].argmax(axis=1), pa.int32()),
                    pa.ListArray.from_arrays(each * np.int32(kind_count + 1), pa.array(counts.ravel(), pa.int32())),
                    pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(each * np.int32(COMMON // 8)), pa.py_buffer(np.packbits(bits, axis=1).tobytes())]),
                    pa.ListArray.from_arrays(ends, grams.flatten().filter(pa.array(at < 0))),
                ],
                names=schema.names,
            )

    return sets.mapInArrow(run, schema)


def blocks_of(texts: DataFrame, count: int) -> DataFrame:
    """Packed texts (id, old, open, values, ...) as a written table of blocks, each of one kind, one `old` and one `open`."""
    order = ["open", "old", "kind", "size"]
    rest = texts.schema["rest"].dataType
    schema = StructType().add("open", "boolean").add("old", "boolean").add("keys", ArrayType(texts.schema["id"].dataType))
    schema = schema.add("counts", INTS).add("lo", INTS).add("hi", INTS).add("bits", "binary")
    schema = schema.add("rest", rest).add("rests", INTS).add("values", ArrayType(LongType()))

    def block(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        one = lambda c: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c)
        column = lambda c: t.column(c).chunk(0)
        counts = column("counts").flatten()
        parts = np.stack([column("size").to_numpy(), *counts.to_numpy().reshape(t.num_rows, -1).T])
        return pa.RecordBatch.from_arrays(
            [
                column("open").slice(0, 1),
                column("old").slice(0, 1),
                one(column("id")),
                one(counts),
                one(pa.array(parts.min(axis=1), pa.int32())),
                one(pa.array(parts.max(axis=1), pa.int32())),
                pa.array([pa.compress(b"".join(column("bits").to_pylist()), PACKING, asbytes=True)], pa.binary()),
                one(column("rest").flatten()),
                one(pa.array(column("rest").value_lengths(), pa.int32())),
                one(column("values").flatten()),
            ],
            names=schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, last = 0, None
        for batch in batches:
            while batch.num_rows:
                kinds = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in order[:3]])
                if rows and (rows == BLOCK or (kinds[:, 0] != last).any()):
                    yield block(pa.Table.from_batches(held))
                    held, rows = [], 0
                changes = np.flatnonzero((kinds != kinds[:, :1]).any(axis=0))
                n = min(BLOCK - rows, int(changes[0]) if len(changes) else batch.num_rows)
                held.append(batch.slice(0, n))
                rows, last, batch = rows + n, kinds[:, 0], batch.slice(n)
        if held:
            yield block(pa.Table.from_batches(held))

    dealt = texts.withColumn("__at", F.xxhash64("id")).repartitionByRange(max(1, -(-count // (2 * BLOCK))), *order, "__at")
    made = dealt.sortWithinPartitions(*order, "__at").drop("__at").mapInArrow(run, schema)
    return written(made.withColumn("no", F.monotonically_increasing_id()))


class Block:
    """A block as matrices."""

    def __init__(self, row: dict):
        self.no, self.old = row["no"].as_py(), row["old"].as_py()
        self.keys, self.rest = row["keys"].values, row["rest"].values
        self.counts = row["counts"].values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(self.keys), -1)
        self.size = self.counts.sum(axis=1)
        self.rests = row["rests"].values.to_numpy(zero_copy_only=False).astype(np.int64)
        self.values = row["values"].values.to_numpy(zero_copy_only=False).reshape(len(self.size), -1)
        size = len(self.size) * COMMON // 8
        self.bytes = np.frombuffer(pa.decompress(row["bits"].as_buffer(), size, PACKING), np.uint8).reshape(len(self.size), -1)
        self.bits = np.unpackbits(self.bytes, axis=1)
        self.share = self.bits.mean(axis=0, dtype=np.float32)


def rest_words(block: Block, shared: pa.Array) -> np.ndarray:
    """Bits of a block's texts for the grams of `shared`, as words."""
    at = pc.fill_null(pc.index_in(block.rest, value_set=shared), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(block.size)), block.rests)[at >= 0]
    at = at[at >= 0]
    out = np.zeros((len(block.size), -(-len(shared) // 64)), np.uint64)
    np.bitwise_or.at(out, (row, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    return out


def whole_sets(a: Block, b: Block) -> np.ndarray:
    """The sets of two blocks, one after the other, as words of bits; other grams than the common ones only if both blocks have them."""
    words = [side.bytes.view(np.uint64) for side in (a, b)]
    shared = pc.unique(a.rest.filter(pc.is_in(a.rest, value_set=b.rest)))
    if len(shared):
        words = [np.concatenate([w, rest_words(side, shared)], axis=1) for w, side in zip(words, (a, b), strict=True)]
    return np.concatenate(words)


def in_reach(a: Block, b: Block, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks of which sizes and counts leave it open whether they are alike to a row of the other; see `comparable`."""
    rows = [np.arange(len(a.size)), np.arange(len(b.size))]
    for side in (0, 1, 0, 1):
        own, other = (a, b) if side == 0 else (b, a)
        mine, rest = rows[side], rows[1 - side]
        if not len(rest):
            return rest, rest
        lo, hi, counts = other.counts[rest].min(axis=0), other.counts[rest].max(axis=0), own.counts[mine]
        least, most, size = other.size[rest].min(), other.size[rest].max(), own.size[mine]
        gap = np.maximum(np.maximum(counts - hi, lo - counts), 0).sum(axis=1)
        near = (gap * (den + num) < (size + most) * (den - num)) & (size * den > least * num) & (most * den > size * num)
        rows[side] = mine[near]
    return rows[0], rows[1]


def within_bound(a: Block, b: Block, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (p, q) of all pairs that may be alike, and maybe of some others."""
    rows = in_reach(a, b, num, den)
    if not len(rows[0]) or not len(rows[1]):
        return
    share = a.share + b.share
    share[(a.share == 0) | (b.share == 0)] = 0
    by_share = np.argsort(-share, kind="stable")
    sizes = [x.size[r] for x, r in zip((a, b), rows, strict=True)]
    most = np.searchsorted(np.cumsum(share[by_share]), (sizes[0].mean() + sizes[1].mean()) * (1 - SLACK))
    taken = by_share[: min(most, np.count_nonzero(share))]
    sides = []
    for x, r, n in zip((a, b), rows, sizes, strict=True):
        side = np.empty((len(r), len(taken) + 2), np.float32)
        side[:, :-2] = np.take(x.bits[r], taken, axis=1) if 4 * len(r) < len(x.bits) else np.take(x.bits, taken, axis=1)[r]
        # What the product leaves out is at most the lesser of the two texts' counts, so at most their mean.
        side[:, -2] = (n - side[:, :-2].sum(axis=1)) / 2 - n * (num / (num + den))
        side[:, -1] = 1
        sides.append(side)
    sides[1][:, [-2, -1]] = sides[1][:, [-1, -2]]
    least = -0.05 - 1e-5 * max(x.max() for x in sizes)
    for start in range(0, len(rows[0]), STRIP):
        at = np.flatnonzero((sides[0][start : start + STRIP] @ sides[1].T).ravel() > least)
        yield rows[0][start + at // len(rows[1])], rows[1][at % len(rows[1])]


def alike_in(a: Block, b: Block, num: int, den: int, later: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(x, y, shared, together) of the alike pairs of two blocks, each once, with an equal value if they have any.

    x is the earlier one; rows of b count on from those of a. With `later` its rows are marked if they resemble an earlier one, and
    pairs that would mark none are left out.
    """
    place = pc.rank(pa.concat_arrays([a.keys, b.keys]), tiebreaker="min").to_numpy().astype(np.int64)
    if a.old != b.old:
        place = np.repeat([not a.old, not b.old], [len(a.size), len(b.size)]).astype(np.int64)
    size, values, words = np.concatenate([a.size, b.size]), np.concatenate([a.values, b.values]), None
    for p, q in within_bound(a, b, num, den):
        q = q + len(a.size)
        keep = place[p] != place[q] if a.no != b.no else (place[p] != place[q]) & (p + len(a.size) < q)
        p, q = p[keep], q[keep]
        if not len(p):
            continue
        first = place[p] < place[q]
        x, y = np.where(first, p, q), np.where(first, q, p)
        words = whole_sets(a, b) if words is None else words
        for start in range(0, len(x), CHUNK):
            i, j = x[start : start + CHUNK], y[start : start + CHUNK]
            if later is not None:
                i, j = i[~later[j]], j[~later[j]]
            if values.shape[1]:
                same = (values[i] == values[j]).any(axis=1)
                i, j = i[same], j[same]
            shared = np.bitwise_count(words[i] & words[j]).sum(axis=1, dtype=np.int64)
            together = size[i] + size[j] - shared
            good = shared * den > together * num
            i, j, shared, together = i[good], j[good], shared[good], together[good]
            if later is not None:
                later[j] = True
            yield i, j, shared, together


def compared(blocks: DataFrame, threshold: tuple[int, int], whole: bool) -> DataFrame:
    """(a, b, shared, together) of the alike pairs, a the earlier; without `whole` only b, often more than once."""
    num, den = threshold
    ids = blocks.schema["keys"].dataType.elementType
    out = StructType().add("a", ids).add("b", ids).add("shared", "long").add("together", "long") if whole else StructType().add("b", ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Block] = {}

        def block(batch: pa.RecordBatch, side: str, k: int) -> Block:
            no = batch.column(f"{side}_no")[k].as_py()
            if no not in known:
                while len(known) > 2:
                    known.pop(next(iter(known)))
                known[no] = Block({c: batch.column(f"{side}_{c}")[k] for c in NEEDED})
            return known[no]

        for batch in batches:
            for k in range(batch.num_rows):
                a, b = block(batch, "l", k), block(batch, "r", k)
                keys = pa.concat_arrays([a.keys, b.keys])
                if whole:
                    for x, y, shared, together in alike_in(a, b, num, den):
                        pair = [keys.take(pa.array(x)), keys.take(pa.array(y))]
                        yield pa.RecordBatch.from_arrays([*pair, pa.array(shared), pa.array(together)], names=out.names)
                    continue
                later = np.zeros(len(keys), bool)
                for _ in alike_in(a, b, num, den, later):
                    pass
                if later.any():
                    yield pa.RecordBatch.from_arrays([keys.filter(pa.array(later))], names=["b"])

    sides = [blocks.select(*(F.col(c).alias(f"{s}_{c}") for c in (*NEEDED, "open", "lo", "hi"))) for s in "lr"]
    return sides[0].hint("shuffle_replicate_nl").join(sides[1], comparable(num, den)).select(*(f"{s}_{c}" for s in "lr" for c in NEEDED)).mapInArrow(run, out)


NEEDED = ("no", "old", "keys", "counts", "bits", "rest", "rests", "values")


def comparable(num: int, den: int) -> Column:
    """Whether two blocks l and r are to be compared: once, with an open one, and not if sizes or counts are too far apart.

    Sets a and b with more than num / den of their grams in common differ in less than (|a| + |b|) * (den - num) / (den + num)
    grams; they differ in as many as the counts of any parts of them do, added up.
    """
    apart = lambda x, y: F.greatest(x["lo"] - y["hi"], y["lo"] - x["hi"], F.lit(0))
    gaps = F.zip_with(
        F.arrays_zip(F.col("l_lo").alias("lo"), F.col("l_hi").alias("hi")), F.arrays_zip(F.col("r_lo").alias("lo"), F.col("r_hi").alias("hi")), apart
    )
    gap = F.aggregate(F.slice(gaps, 2, F.size(gaps) - 1), F.lit(0), lambda s, x: s + x)
    near = gap.cast("long") * (den + num) < (F.col("l_hi")[0] + F.col("r_hi")[0]).cast("long") * (den - num)
    fits = (F.col("l_hi")[0].cast("long") * den > F.col("r_lo")[0] * num) & (F.col("r_hi")[0].cast("long") * den > F.col("l_lo")[0] * num)
    return (F.col("l_no") <= F.col("r_no")) & (F.col("l_open") | F.col("r_open")) & ~(F.col("l_old") & F.col("r_old")) & fits & near


def alike_pairs(sets: DataFrame, threshold: tuple[int, int], whole: bool = False, only: DataFrame | None = None, known: DataFrame | None = None, near: DataFrame | None = None) -> DataFrame:
    """The alike pairs of `sets`, a written table; see `compared`.

    sets: (id, grams) and maybe: same, of which the row with the least id counts (a null id is the least, and resembles
    nothing); values, of which a pair must share one in the same place. only: ids of which a pair must have one; known: (id, grams)
    of older sets, which come before all of `sets` and are not compared with each other, or those with the ids in `near`.
    """
    common = commonest(sets)
    total = sets.count()
    few = sets.where(F.pmod(F.xxhash64("id"), F.lit(max(1, total // SAMPLE))) == 0).select("grams").limit(SAMPLE).collect()
    of = to_arrow_type(sets.schema["grams"].dataType)
    kinds = kinds_of(bits_of(pa.array([r["grams"] for r in few], of), pa.array(common, of.value_type))[0])
    none = F.array().cast("array<long>").alias("values")
    texts = packed(sets if "values" in sets.columns else sets.select("*", none), common, kinds)
    if "same" in texts.columns:
        rows = F.struct("id", *(c for c in texts.columns if c not in ("id", "same"))).alias("row")
        texts = texts.groupBy("same").agg(F.min(rows).alias("row")).select("row.*")
    texts = texts.withColumn("old", F.lit(False))
    if only is None:
        texts = texts.withColumn("open", F.lit(True))
    else:
        texts = texts.join(only.select("id", F.lit(True).alias("open")), "id", "left").withColumn("open", F.col("open").isNotNull())
    if known is not None:
        total += known.count()
        older = packed(known.select("id", "grams", none), common, kinds)
        older = older if near is None else older.join(near, "id", "left_semi")
        texts = texts.unionByName(older.select("*", F.lit(True).alias("old"), F.lit(False).alias("open")))
    return compared(blocks_of(texts.where(F.col("id").isNotNull()), total), threshold, whole)
