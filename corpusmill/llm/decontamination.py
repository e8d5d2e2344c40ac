"""Benchmark decontamination with a generalised suffix automaton over test-item words.

The automaton holds every substring of every item. A document's words are streamed
through it; after each word the automaton knows the longest run of words, ending there,
that occurs in some item. Where the run reaches a window's length, those words are hit.

Spark sums the items' bytes first. While they are within BLOCK_BYTES there is one
automaton; beyond, items are hashed into blocks of about that size and the documents pass
one block after the other, so that neither the driver nor a worker holds more than a block.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import column, stash, table

WINDOW = 13
COVERAGE = 20  # contaminated where hit words are at least a 20th of all words
BLOCK_BYTES = 1 << 20

#: Lower-cases A-Z and turns every byte outside words into a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str | bytes | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(_FOLD).split()


class Automaton:
    """Suffix automaton of several word sequences, cut to windows of `window` words.

    `marks[v]` tells, for a run that ends in state v, the window lengths that end there:
    (length, items) with the longest first. Windows are all runs of `window` words of an
    item, and the whole item where that is shorter.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = list(items)
        for _, seq in items:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        # Only now are states final: a later item may split the state of an earlier one's words.
        ends: dict[int, set] = {}
        short: dict[int, dict[int, set]] = {}
        for name, seq in items:
            if not seq:
                continue
            if len(seq) < window:
                short.setdefault(self._state(seq), {}).setdefault(len(seq), set()).add(name)
            else:
                for i in range(window, len(seq) + 1):
                    ends.setdefault(self._state(seq[i - window : i]), set()).add(name)
        # States get the windows of their own and of all states on their suffix links.
        self.marks: list[tuple[tuple[int, frozenset], ...]] = [()] * len(self.link)
        for v in sorted(range(len(self.link)), key=self.length.__getitem__):
            own = []
            if v in ends:
                own.append((window, frozenset(ends[v])))
            own += [(n, frozenset(x)) for n, x in sorted(short.get(v, {}).items(), reverse=True)]
            above = self.marks[self.link[v]] if v else ()
            self.marks[v] = (*own, *above)
        # Beyond the window only the fact that it was reached counts.
        self.enough = [bool(m) for m in self.marks]

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: bytes, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = c
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def _state(self, seq: list[bytes]) -> int:
        v = 0
        for w in seq:
            v = self.next[v][w]
        return v

    def windows(self, seq: list[bytes]) -> Iterator[tuple[int, int, frozenset]]:
        """(start, end, items) of each window found in a document's words."""
        nxt, link, length, marks, enough = self.next, self.link, self.length, self.marks, self.enough
        root = nxt[0]
        v = have = 0
        for i, w in enumerate(seq, 1):
            if v:
                step = nxt[v].get(w)
                while step is None and v:
                    v = link[v]
                    have = length[v]
                    step = nxt[v].get(w)
                if step is None:
                    v = have = 0
                    continue
                v = step
                have += 1
            elif (step := root.get(w)) is not None:
                v, have = step, 1
            else:
                continue
            if enough[v]:
                for n, items in marks[v]:
                    if n <= have:
                        yield i - n, i, items


def hit_spans(automaton: Automaton, seq: list[bytes], earlier: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], set]:
    """Merged spans of hit words, ascending, and the items whose windows occur."""
    found, items = list(earlier), set()
    for start, end, names in automaton.windows(seq):
        found.append((start, end))
        items |= names
    spans: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans, items


def benchmark_blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items as (item_id, words), in blocks of about `most` bytes of text, one at a time.

    A null text has no words; a null item_id is named by the empty string.
    """
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // most) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        rows = benchmark.where(block == k).select("item_id", "text").toLocalIterator()
        yield [("" if x["item_id"] is None else str(x["item_id"]), words(x["text"])) for x in rows]


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and without what stands between them."""
    raw = text.encode()
    at = [m.span() for m in re.finditer(rb"[0-9a-z\x80-\xff]+", raw.translate(_FOLD))]
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, raw[done:]]).decode()


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_ADDED = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()), "spans": pa.list_(_SPAN)}


def _pass(docs: DataFrame, block: list, window: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(sent.value, window)
        for batch in batches:
            cols: dict[str, list] = {k: [] for k in _ADDED}
            earlier = zip(batch.column("items").to_pylist(), batch.column("spans").to_pylist(), strict=True)
            for text, (items, spans) in zip(batch.column("text"), earlier, strict=True):
                seq = words(text.as_py())
                found, names = hit_spans(automaton, seq, [(x["start"], x["end"]) for x in spans])
                cols["n_words"].append(len(seq))
                cols["n_hit"].append(sum(b - a for a, b in found))
                cols["items"].append(sorted(names.union(items)))
                cols["spans"].append([{"start": a, "end": b} for a, b in found])
            put = {n: c for n, c in zip(batch.schema.names, batch.columns, strict=True)}
            put |= {k: pa.array(cols[k], t) for k, t in _ADDED.items()}
            yield pa.RecordBatch.from_arrays(list(put.values()), list(put))

    return docs.mapInArrow(run, docs.schema)


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns of docs, with n_words, n_hit, items and spans (in words, end exclusive) added.

    A null text has no words and no hits. Repeated rows are judged each. Input columns
    named like an added one are replaced, others may have any names. No items means no hits, no
    rows give no rows, and texts are searched whole, however long.
    """
    empty = {
        "n_words": F.lit(0).cast("long"),
        "n_hit": F.lit(0).cast("long"),
        "items": F.array().cast("array<string>"),
        "spans": F.array().cast("array<struct<start:int,end:int>>"),
    }
    order = [c for c in docs.columns if c not in empty]
    row = F.struct(F.lit(0).alias("0"), *(column(c) for c in order if c != "text")).alias("row")
    found = docs.select(row, "text").withColumns(empty)
    for k, block in enumerate(benchmark_blocks(benchmark, block_bytes)):
        found = _pass(stash(found, "decontamination") if k else found, block, window)
    return found.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in order), *empty)


def contaminated(coverage: int = COVERAGE) -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, longest: int | None = None, window: int = WINDOW, coverage: int = COVERAGE
) -> DataFrame:
    """The documents that are left, with the columns of docs.

    Documents whose hit words exceed the coverage limit go (a tie is over it). With `longest`,
    spans of more words than that are cut out of the texts of the others. Columns of docs can
    have any names and pass unchanged; nulls and empty texts have no words and stay, repeated
    rows are judged each, and no rows give no rows.
    """
    row = F.struct(*(column(c) for c in docs.columns if c != "text")).alias("row")
    left = find(docs.select(row, "text"), benchmark, window).where(~contaminated(coverage))
    if longest is not None:
        left = _without_spans(left.select("row", "text", F.filter("spans", lambda x: x["end"] - x["start"] > longest).alias("spans")))
    return left.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))


def _without_spans(docs: DataFrame) -> DataFrame:
    """docs with the words of `spans` cut out of `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                cut_words(text.as_py(), [(x["start"], x["end"]) for x in spans.as_py()]) if len(spans) else text.as_py()
                for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True)
            ]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


OP9_SQL = r"""
WITH fold AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
items AS (SELECT id, w, least(13, len(w)) AS n FROM fold WHERE kind = 'b' AND len(w) > 0),
win AS (SELECT DISTINCT id, n, array_to_string(w[i:i + n - 1], ' ') AS txt
        FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
docs AS (SELECT id, coalesce(w, []) AS w FROM fold WHERE kind = 'd'),
pos AS (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (SELECT pos.id, pos.i, pos.n, win.id AS item FROM pos JOIN win ON win.n = pos.n AND win.txt = array_to_string(w[i:i + pos.n - 1], ' ')),
covered AS (SELECT id, count(DISTINCT spot) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS spot FROM hit) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM hit) GROUP BY id)
SELECT docs.id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (id) LEFT JOIN named USING (id)
"""
