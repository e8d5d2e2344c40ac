"""Repeated-passage removal by a depth-limited radix sort of suffixes.

Suffixes are ordered by most-significant-digit passes through their first `length` bytes
only; suffixes still equal then start a repeated window. A suffix whose class has become a
singleton leaves before the next pass, so that later digits are read for few of them.

Pass 1 is a Spark aggregation. Its digit must not cost a row for each byte, hence it isn't
the window's first bytes but its anchor: the 32-byte string with the least hash in the
window (leftmost of equals). Equal windows have equal anchors at equal places, and
neighbouring windows share theirs, so that a run of windows travels as one row.
Pass 2 compares the whole stretch of text that a run covers. Runs with an equal in the
corpus are repeated as a whole. For the others, the passes over the windows themselves
follow, digit by digit, inside tasks that each see whole anchor classes. A class too large
for that is cut into parts, for which the same passes are aggregations: at every digit each
part sends what its windows have so far to the tasks that count it over all parts, and
goes on with the windows that are repeated.

Hashes of prefix sums find candidates only, as texts can be made for which they collide. What is
removed rests on bytes: runs are equal by 128 bits of BLAKE2 of their stretch, windows in a
task by comparing them byte by byte, and windows of parts by 128 bits of BLAKE2.

A run's windows start less than `length` bytes apart. The bytes they cover together are
therefore known from the first and the last repeated one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import BYTE, powers, chunks, mix, stash, table, utf8

LENGTH = 200
GRAM = 32
HOT = 1000  # different runs of an anchor class that a task sorts; more are cut into parts
COMMON = 10_000  # kinds of runs that are broadcast, at most
SLAB = 1 << 18  # windows sorted at once in a task
_PLACE = np.uint64((1 << 31) - 1)
_ODD = np.uint64(0xD6E8FEB86659FD93)


class Prefix:
    """Hashes of substrings of a buffer by its prefix sums."""

    def __init__(self, raw: np.ndarray):
        self.power, self.inverse = powers(len(raw) + 1)
        self.total = np.empty(len(raw) + 1, np.uint64)
        self.total[0] = 0
        np.cumsum(BYTE[raw] * self.power[: len(raw)], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.inverse[start])


def runs(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one anchor: (row, anchor hash, anchor, first start, last start).

    Starts and anchors count from the row's own beginning.
    """
    n = len(raw)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none, none, none
    prefix = Prefix(raw)
    h = mix((prefix.total[gram:] - prefix.total[:-gram]) * prefix.inverse[: n - gram + 1])
    # Least hash in each window of `wide` grams; the place in the low bits breaks ties.
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    wide, step = length - gram + 1, 1
    while 2 * step <= wide:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < wide:
        low = np.minimum(low[: len(low) - (wide - step)], low[wide - step :])
    anchor = (low & _PLACE).astype(np.int64)  # of the window that starts here
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    inside = np.flatnonzero(np.arange(len(anchor)) + length <= offsets[1:][row])
    if len(inside) == 0:
        return none, none.astype(np.uint64), none, none, none
    at = anchor[inside]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.append(first[1:], len(at)) - 1
    s, e, p = inside[first], inside[last], at[first]
    r = row[s]
    return r, h[p], p - offsets[r], s - offsets[r], e - offsets[r]


def digest(raw: bytes | memoryview) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def digits_of(length: int) -> list[int]:
    """Where the digits of a window end: a third of it each."""
    third = -(-length // 3)
    return [min(a + third, length) for a in range(0, length, third)]


def windows(texts: list[bytes], length: int = LENGTH):
    """(text number, start, prefix hashes, absolute start) of all windows of some texts."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    base = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
    n = np.maximum(size - length + 1, 0)
    text = np.repeat(np.arange(len(texts)), n)
    start = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return text, start, Prefix(raw), base[text] + start


def repeated(group: np.ndarray, weight: np.ndarray, texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of a repeated window in each text, or -1.

    Windows are equal within a group only. Most-significant digits first: after each pass
    the classes whose weight is below two leave.
    """
    text, start, prefix, at = windows(texts, length)
    left = np.arange(len(text))
    cls = mix(group[text].astype(np.uint64) * _ODD)
    a = 0
    for upto in digits_of(length):
        digit, a = prefix.of(at[left] + a, at[left] + upto), upto
        cls = mix(cls ^ (digit * _ODD))
        _, inverse = np.unique(cls, return_inverse=True)
        keep = np.bincount(inverse, weight[text[left]])[inverse] >= 2
        left, cls = left[keep], cls[keep]
    left = _really_repeated(left, cls, at, text, weight, group, b"".join(texts), length)
    first, last = np.full(len(texts), -1), np.full(len(texts), -1)
    first[text[left][::-1]] = start[left][::-1]
    last[text[left]] = start[left]
    return first, last


def _really_repeated(left, cls, at, text, weight, group, raw: bytes, length: int, most: int = 1 << 15) -> np.ndarray:
    """Those of the windows `left` that are repeated by their bytes, given classes of equal hashes.

    Neighbours in the order of classes are compared; a class with any difference is dealt anew.
    """
    order = np.argsort(cls, kind="stable")
    view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), length) if len(raw) >= length else None
    differ = np.zeros(len(order), bool)
    for k in range(1, len(order), most):
        x, y = order[k - 1 : k - 1 + most], order[k : k + most]
        x, same = x[: len(y)], cls[x[: len(y)]] == cls[y]
        one, two = left[x[same]], left[y[same]]
        other = (view[at[one]] != view[at[two]]).any(axis=1) | (group[text[one]] != group[text[two]])
        differ[k + np.flatnonzero(same)[other]] = True
    if not differ.any():
        return left
    odd = np.isin(cls, cls[order[differ]])
    rest = np.flatnonzero(odd)
    keys = [(group[text[w]], raw[at[w] : at[w] + length]) for w in left[rest]]
    total: dict[tuple, int] = {}
    for key, w in zip(keys, left[rest], strict=True):
        total[key] = total.get(key, 0) + int(weight[text[w]])
    odd[rest] = [total[key] < 2 for key in keys]
    return left[~odd]


_RUN = "doc_id long, k long, h long, c long, d long, s int, e int"


def find_anchors(docs: DataFrame, length: int) -> DataFrame:
    """h of each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = utf8(batch.column("text"))
            for a, b in chunks(offs, 1 << 18):
                part = offs[a : b + 1]
                h = runs(raw[part[0] : part[-1]], part - part[0], length)[1]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    return docs.select("text").mapInArrow(run, "h long")


def find_runs(docs: DataFrame, length: int) -> DataFrame:
    """One row for each run: its document, anchor class h, stretch (c, d), first and last start.

    Runs have equal (c, d) if their stretches and the places of their windows in these are equal.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = utf8(batch.column("text"))
            doc, key = batch.column("doc_id"), batch.column("k")
            for a, b in chunks(offs, 1 << 18):
                part = offs[a : b + 1]
                r, h, p, s, e = runs(raw[part[0] : part[-1]], part - part[0], length)
                if len(r):
                    rows = pa.array(r + a)
                    text = raw[part[0] : part[-1]].tobytes()
                    spans = zip((part[r] - part[0] + s).tolist(), (part[r] - part[0] + e + length).tolist(), (p - s).tolist(), strict=True)
                    c = np.frombuffer(b"".join(digest(text[i:j] + k.to_bytes(4, "little")) for i, j, k in spans), np.int64).reshape(-1, 2)
                    cols = [doc.take(rows), key.take(rows), pa.array(h.view(np.int64)), pa.array(c[:, 0]), pa.array(c[:, 1])]
                    cols += [pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(cols, ["doc_id", "k", "h", "c", "d", "s", "e"])

    return docs.mapInArrow(run, _RUN)


_CONTEXT = "doc_id long, k long, h long, parts int, weight int, s long, stretch binary"
_NAMES = ["doc_id", "k", "h", "parts", "weight", "s", "stretch"]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]


def _stretches(batches: Iterator[pa.RecordBatch], length: int, most: int = 2000) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs in column `todo` of each document, `most` at a time.

    Rows repeated with their doc_id have the same runs; a task sends them once.
    """
    rows: list[tuple] = []
    sent: set[tuple] = set()

    def out() -> pa.RecordBatch:
        made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(made, _NAMES)

    for doc, k, text, todo in (x for b in batches for x in zip(*(b.column(c) for c in ("doc_id", "k", "text", "todo")), strict=True)):
        doc, k = doc.as_py(), k.as_py()
        if (doc, k) in sent:
            continue
        if any(x["weight"].as_py() > 1 for x in todo):
            sent.add((doc, k))
        raw = (text.as_py() or "").encode()
        for x in todo:
            s = x["s"].as_py()
            h, parts, weight = (x[n].as_py() for n in ("h", "parts", "weight"))
            rows.append((doc, k, h, parts, weight, s, raw[s : x["e"].as_py() + length]))
            if len(rows) >= most:
                yield out()
    if rows:
        yield out()


_SPAN = "doc_id long, k long, a long, b long"


def _sort_classes(marked: DataFrame, length: int) -> DataFrame:
    """Spans found in classes that a task can hold, whole classes at a time."""

    def spans(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        weight = t["weight"].to_numpy()
        first, last = repeated(t["h"].to_numpy(), weight, t["stretch"].to_pylist(), length)
        hit = np.flatnonzero((first >= 0) & (weight == 1))
        s = t["s"].to_numpy()[hit]
        rows = pa.array(hit)
        cols = [t["doc_id"].combine_chunks().take(rows), t["k"].combine_chunks().take(rows)]
        cols += [pa.array(s + first[hit]), pa.array(s + last[hit] + length)]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "k", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows * length  # a run has fewer windows than `length`
            if size < SLAB:
                continue
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            h = whole.column("h").to_numpy()
            change = np.flatnonzero(h != h[-1])
            if len(change) == 0:
                continue
            cut = int(change[-1]) + 1  # the last class may go on in the next batch
            for i, j in _groups(h[:cut], SLAB // length):
                yield spans([whole.slice(i, j - i)])
            held, size = [whole.slice(cut)], (whole.num_rows - cut) * length
        if held:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()
            for part in whole:
                for i, j in _groups(part.column("h").to_numpy(), SLAB // length):
                    yield spans([part.slice(i, j - i)])

    contexts = marked.mapInArrow(lambda batches: _stretches(batches, length), _CONTEXT)
    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(run, _SPAN)


def _groups(h: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of about `most` rows that split no run of equal values."""
    ends = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, len(h)) if len(h) else []
    first = 0
    for end in ends:
        if end - first >= most or end == len(h):
            yield first, int(end)
            first = int(end)


_PART = "h long, part int, bucket int, digits binary, twice binary"
_WHOLE = np.dtype([("x", np.uint64), ("y", np.uint64)])  # 128 bits of BLAKE2


def _digits(raw: bytes, prefix: Prefix, at: np.ndarray, upto: int, length: int) -> np.ndarray:
    """What windows are compared by when `upto` bytes are read: a hash, and a digest once they are whole."""
    if upto < length:
        return prefix.of(at, at + upto)
    return np.frombuffer(b"".join([digest(raw[i : i + length]) for i in at.tolist()]), _WHOLE)


def _left_in_parts(parts: pa.Table, again: pa.Table | None, depth: int, length: int) -> tuple:
    """Windows of some runs, without those whose first `depth` bytes are known to be single."""
    texts = parts["stretch"].to_pylist()
    text, start, prefix, at = windows(texts, length)
    raw = b"".join(texts)
    if again is None:
        return text, start, prefix, at, raw
    kind = np.dtype(np.uint64) if depth < length else _WHOLE
    known = [np.frombuffer(x.as_buffer(), kind) for x in again["digits"].combine_chunks()]
    hit = np.isin(_digits(raw, prefix, at, depth, length), np.concatenate(known)) if known else np.zeros(len(at), bool)
    return text[hit], start[hit], prefix, at[hit], raw


def _send_digits(key: tuple, parts: pa.Table, again: pa.Table | None, depth: int, upto: int, length: int) -> pa.Table:
    """A part's distinct digits of `upto` bytes by bucket, and whether the part alone repeats them."""
    n = parts["parts"][0].as_py()
    text, _, prefix, at, raw = _left_in_parts(parts, again, depth, length)
    digit, inverse = np.unique(_digits(raw, prefix, at, upto, length), return_inverse=True)
    twice = np.bincount(inverse, parts["weight"].to_numpy()[text], len(digit)) >= 2
    bucket = (digit if upto < length else digit["x"]) % np.uint64(n)
    rows = [(b, digit[bucket == b].tobytes(), twice[bucket == b].tobytes()) for b in np.unique(bucket).tolist()]
    kinds = (pa.int32(), pa.binary(), pa.binary())
    cols = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
    same = [pa.array([key[0].as_py()] * len(rows), pa.int64()), pa.array([key[1].as_py()] * len(rows), pa.int32())]
    return pa.Table.from_arrays([*same, *cols], ["h", "part", "bucket", "digits", "twice"])


def _count_digits(key: tuple, rows: pa.Table, whole: bool) -> pa.Table:
    """For each part the digits of a bucket that are repeated over all parts."""
    kind = _WHOLE if whole else np.dtype(np.uint64)
    parts = [np.frombuffer(x.as_buffer(), kind) for x in rows["digits"].combine_chunks()]
    own = [np.frombuffer(x.as_buffer(), bool) for x in rows["twice"].combine_chunks()]
    every, inverse = np.unique(np.concatenate(parts), return_inverse=True)
    again = np.bincount(inverse, 1 + np.concatenate(own), len(every))[inverse] >= 2
    cuts = np.cumsum([len(x) for x in parts])[:-1]
    found = [p[a].tobytes() for p, a in zip(parts, np.split(again, cuts), strict=True)]
    return pa.Table.from_arrays([rows["h"], rows["part"], pa.array(found, pa.binary())], ["h", "part", "digits"])


def _mark_parts(key: tuple, parts: pa.Table, again: pa.Table, length: int) -> pa.Table:
    """Spans from the first to the last repeated window of each run of a part."""
    text, start, *_ = _left_in_parts(parts, again, length, length)
    first, last = np.full(parts.num_rows, -1), np.full(parts.num_rows, -1)
    first[text[::-1]] = start[::-1]
    last[text] = start
    rows = np.flatnonzero((first >= 0) & (parts["weight"].to_numpy() == 1))
    s = parts["s"].to_numpy()[rows]
    kept = parts.take(pa.array(rows))
    cols = [kept["doc_id"], kept["k"], pa.array(s + first[rows]), pa.array(s + last[rows] + length)]
    return pa.Table.from_arrays(cols, ["doc_id", "k", "a", "b"])


def _sort_large_classes(marked: DataFrame, length: int) -> DataFrame:
    """Spans found in classes that are cut into parts."""
    contexts = marked.mapInArrow(lambda batches: _stretches(batches, length), _CONTEXT)
    contexts = contexts.withColumn("part", F.pmod(F.xxhash64("doc_id", "k", "s"), F.col("parts")).cast("int"))
    parts = contexts.groupBy("h", "part")

    def first(upto: int):
        return parts.applyInArrow(lambda key, a: _send_digits(key, a, None, 0, upto, length), _PART)

    def narrowed(again: DataFrame, depth: int, upto: int):
        both = parts.cogroup(again.groupBy("h", "part"))
        return both.applyInArrow(lambda key, a, b: _send_digits(key, a, b, depth, upto, length), _PART)

    def counted(sent: DataFrame, whole: bool) -> DataFrame:
        count = lambda key, rows: _count_digits(key, rows, whole)
        return sent.groupBy("h", "bucket").applyInArrow(count, "h long, part int, digits binary")

    again, depth = None, 0
    for upto in digits_of(length):
        sent = first(upto) if again is None else narrowed(again, depth, upto)
        again, depth = counted(sent, upto == length), upto
    both = parts.cogroup(again.groupBy("h", "part"))
    return both.applyInArrow(lambda key, a, b: _mark_parts(key, a, b, length), _SPAN)


def marked_runs(found: DataFrame, hot: int = HOT) -> DataFrame:
    """Runs with n (runs of this kind), parts of their class, and whether they are `todo`.

    A run without an equal is compared with one run of each kind in its class, so that
    copies of a text don't fill a task. The table of kinds is joined by shuffle but for the kinds
    that hold more than 1 / COMMON of all runs: these are COMMON at most, and are broadcast.
    """
    pick = F.xxhash64("doc_id", "k", "s")
    kinds = stash(found.groupBy("h", "c", "d").agg(F.count(F.lit(1)).alias("n"), F.min(pick).alias("pick")), "suffix-stretches")
    classes = (
        kinds.groupBy("h")
        .agg(F.count_if(F.col("n") == 1).alias("single"), F.count(F.lit(1)).alias("different"))
        .where("single > 0")
        .select("h", F.ceil(F.col("different") / hot).cast("int").alias("parts"))
    )
    # Both are written tables, so that Spark can split a class of many kinds.
    kinds = stash(kinds.join(stash(classes, "suffix-classes"), "h", "left"), "suffix-kinds")
    all_runs = kinds.agg(F.sum("n")).first()[0] or 0
    common = F.broadcast(kinds.where(F.col("n") * COMMON > all_runs))
    same = ["h", "c", "d"]
    rest = found.join(common, same, "left_anti").join(kinds.where(F.col("n") * COMMON <= all_runs), same)
    marks = found.join(common, same).unionByName(rest)
    return marks.withColumn("todo", F.col("parts").isNotNull() & (F.col("pick") == pick)).drop("pick")


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """docs must have doc_id, k (hash of the text) and text. Gives (doc_id, k, spans).

    spans: byte ranges whose union is what repeated windows cover, for documents with any.
    """
    # The tables of keys are written, so that joins with them deal anew and Spark can split a hot key.
    again = find_anchors(docs, length).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    found = stash(find_runs(docs, length).join(stash(again, "suffix-keys"), "h", "left_semi"), "suffix-runs")
    marks = marked_runs(found, hot)
    weight = F.least("n", F.lit(2)).cast("int")
    lists = (
        marks.where("todo")
        .groupBy("doc_id", "k")
        .agg(F.collect_set(F.struct("h", "parts", weight.alias("weight"), "s", "e")).alias("todo"))
    )
    whole = marks.where("n > 1").select(
        "doc_id", "k", F.col("s").cast("long").alias("a"), (F.col("e") + F.lit(length)).cast("long").alias("b")
    )
    marked = _with(docs, lists, "inner")
    some = lambda p: marked.withColumn("todo", F.filter("todo", p)).where(F.size("todo") > 0)
    small = _sort_classes(some(lambda x: x["parts"] == 1), length)
    large = _sort_large_classes(some(lambda x: x["parts"] > 1), length)
    return (
        whole.unionByName(small)
        .unionByName(large)
        .groupBy("doc_id", "k")
        .agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    )


def _with(docs: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """docs with the other columns of a table keyed by doc_id (null is a value) and k."""
    other = other.withColumnsRenamed({"doc_id": "__doc", "k": "__k"})
    on = docs["doc_id"].eqNullSafe(other["__doc"]) & (docs["k"] == other["__k"])
    return docs.join(other, on, how).drop("__doc", "__k")


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) of each document.

    Every byte covered by a string of `length` bytes that also starts anywhere else goes.
    A null text is empty. Repeated rows repeat each other and lose all their bytes if
    they have `length` of them. Cuts fall on bytes, so that `kept` need not be UTF-8. No rows give
    no rows, columns other than doc_id and text are not read, and texts are searched whole.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("k"), "text")
    marked = _with(docs, repeated_spans(docs, length, hot), "left")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
            rows = []
            for doc, text, spans in zip(*(batch.column(c) for c in ("doc_id", "text", "spans")), strict=True):
                raw = (text.as_py() or "").encode()
                gone = merge([(x["a"], x["b"]) for x in spans.as_py() or ()])
                ends = [0, *(x for span in gone for x in span), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                rows.append((doc.as_py(), len(raw), len(raw) - len(kept), len(gone), kept))
            cols = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    return marked.select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = remove_repeats(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = """
WITH d AS (SELECT row_number() OVER () AS id, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT id, i, md5(substring(h, 2 * i - 1, 400)) AS k FROM (SELECT id, h, unnest(range(1, len(h) // 2 - 198)) AS i FROM d)),
r AS (SELECT id, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
f AS (SELECT id, i, i > coalesce(lag(i) OVER (PARTITION BY id ORDER BY i), -1000) + 200 AS fresh FROM r),
g AS (SELECT id, i, sum(fresh::INT) OVER (PARTITION BY id ORDER BY i) AS span FROM f),
s AS (SELECT id, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY id, span),
pieces AS (SELECT id, a, b, coalesce(lag(b) OVER (PARTITION BY id ORDER BY a), 1) AS since FROM s),
t AS (SELECT id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
             string_agg(substring(h, 2 * since - 1, 2 * (a - since)), '' ORDER BY a) AS kept FROM pieces JOIN d USING (id) GROUP BY id)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE kept || substring(h, 2 * last - 1) END)) AS kept_sha256
FROM d LEFT JOIN t USING (id)
"""
