"""Near duplicates: n-gram Jaccard self-join by a MinHash LSH forest with exact verification.

Every distinct text has a path of DEPTH MinHash values in each of TREES trees. A tree is
the prefix trie of these paths: its nodes at depth d are the groups of texts whose first d
values agree, found by one aggregation. Two texts of similarity s share a node at depth d
in some tree with probability 1 - (1 - s^d)^TREES.

Matching begins with whole paths. The pairs met there, weighted by the chance to meet them,
tell how similarities are spread in this corpus, and so which share of all linked pairs a
shorter prefix would meet. The prefix is shortened to the longest one that reaches the target
recall. After the pairs met at that depth are verified, the recall is measured again with
their true similarities, and the prefix shortened further while it is below the target.

Inside a node every pair is verified on its whole shingle sets, as words, not hashes. Nodes
are cut into blocks and each pair of blocks is a unit of work, so that a large node spreads
over tasks and no pair ever becomes a row: a unit returns the links counted for each text,
and a spanning forest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import SPACE, chunks, mix, stash, table, token_runs, utf8
from corpusmill.llm.components import components

WORDS = 5
TREES = 24
DEPTH = 8  # values of a path
RECALL = 0.99999
BLOCK = 512  # texts of a node that a unit of work compares with as many others
BLOCK_BYTES = 2 << 20
COLUMNS = 1 << 12  # shingles multiplied at once
BINS = 100  # similarities are counted in so many steps
SEED = 5

_rng = np.random.default_rng(SEED)
_FACTOR = _rng.integers(1, 1 << 62, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def met(similarity: float, depth: int) -> float:
    """The chance that two texts share a prefix of `depth` values in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


def recall_at(found: dict[int, int], depth: int, seen: int, threshold: float) -> float:
    """The share of linked pairs that prefixes of `depth` values meet.

    found: pairs by similarity in BINS-ths, met at depth `seen`. A pair stands for as many as
    it takes to meet one like it. One pair at the threshold is added, so that few pairs, or
    none, don't speak for a long prefix.
    """
    weight = {b / BINS: n / met(b / BINS, seen) for b, n in found.items()}
    weight[threshold] = weight.get(threshold, 0) + 1
    return sum(w * met(s, depth) for s, w in weight.items()) / sum(weight.values())


def shorten(found: dict[int, int], seen: int, threshold: float, target: float) -> int:
    """The longest prefix, `seen` at most, that reaches the target recall."""
    return next((d for d in range(seen, 1, -1) if recall_at(found, d, seen, threshold) >= target), 1)


def shingles(raw: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's word n-grams (with repeats) and the offsets of rows into them.

    Words stand between ASCII white space. A row of fewer words is one n-gram; a row
    without words has none.
    """
    t, _, _, rows = token_runs(raw, offsets, SPACE)
    n = np.diff(rows)
    m = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    ends = np.concatenate([[0], np.cumsum(m)])
    first = np.arange(ends[-1]) + np.repeat(rows[:-1] - ends[:-1], m)
    width = np.repeat(np.minimum(n, words), m)
    g = width.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(words):
        has = width > j
        if has.all():
            g += t[first + j] * _FACTOR[j]
        else:
            g[has] += t[first[has] + j] * _FACTOR[j]
    return mix(g), ends


def tree_paths(g: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The paths of each row, TREES x DEPTH values of 16 bits; rows must not be empty."""
    rng = np.random.default_rng(SEED + 1)
    a = rng.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)
    x = (g >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(ends) - 1, TREES * DEPTH), ">u2")
    for i in range(TREES * DEPTH):
        low = np.minimum.reduceat(x * a[i] + b[i], ends[:-1]) * np.uint32(0x9E3779B1)
        out[:, i] = (low ^ (low >> np.uint32(15))) >> np.uint32(16)
    return out


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, k, n_bytes, paths): a row for each document; paths is null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = utf8(batch.column("text"))
            for a, b in chunks(offs, 1 << 18):
                part = offs[a : b + 1]
                g, ends = shingles(raw[part[0] : part[-1]], part - part[0], words)
                full = np.diff(ends) > 0
                rows: list[bytes | None] = [None] * (b - a)
                if full.any():
                    for i, path in zip(np.flatnonzero(full), tree_paths(g, np.append(ends[:-1][full], ends[-1])), strict=True):
                        rows[i] = path.tobytes()
                cut = batch.slice(a, b - a)
                cols = [cut.column("doc_id"), cut.column("k"), pa.array(np.diff(part)), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "k", "n_bytes", "paths"])

    return docs.mapInArrow(run, "doc_id long, k binary, n_bytes long, paths binary")


def exact_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The shingle sets of some texts as ascending numbers; equal words, equal numbers."""
    seen: dict[tuple, int] = {}
    out = []
    for text in texts:
        w = (text or "").encode().split()
        grams = zip(*(w[i:] for i in range(words)), strict=False) if len(w) >= words else [tuple(w)] if w else []
        out.append(np.unique(np.fromiter((seen.setdefault(x, len(seen)) for x in grams), np.int64)))
    return out


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of shingles that each text of `left` shares with each of `right`."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(sets[i], sets[j], True)) for j in right] for i in left])
    code = np.concatenate([sets[i] for i in (*left, *right)])
    row = np.repeat(np.arange(len(left) + len(right)), [len(sets[i]) for i in (*left, *right)])
    once = np.bincount(code) < 2  # in one set only: shared by no pair
    place = np.cumsum(~once) - 1
    keep = ~once[code]
    code, row = place[code[keep]], row[keep]
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    out = np.zeros((len(left), len(right)))
    for a in range(0, int(place[-1]) + 1, COLUMNS):
        here = slice(*np.searchsorted(code, (a, a + COLUMNS)))
        x = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        x[row[here], code[here] - a] = 1
        out += x[: len(left)] @ x[len(left) :].T
    return out.astype(np.int64)


def _meet(paths: np.ndarray, left: np.ndarray, right: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Which pairs share a prefix of `depth` values in one of the first `trees` trees."""
    cut = paths[:, :trees, :depth]
    if len(left) * len(right) <= 4096:
        return (cut[left][:, None] == cut[right][None, :]).all(axis=3).any(axis=2)
    out = np.zeros((len(left), len(right)), bool)
    for t in range(trees):
        key = np.ascontiguousarray(cut[:, t]).view(f"V{2 * depth}")[:, 0]
        code = np.unique(key, return_inverse=True)[1]
        out |= code[left][:, None] == code[right][None, :]
    return out


def _agreement(paths: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The share of values on which the paths of each pair agree."""
    flat = paths.reshape(len(paths), -1)
    out = np.zeros((len(left), len(right)), np.int32)
    for i in range(flat.shape[1]):
        out += flat[left, i][:, None] == flat[right, i][None, :]
    return out / flat.shape[1]


def compare(ids: np.ndarray, side: np.ndarray, paths: np.ndarray, texts: list | None, unit: tuple, depth: int, before: int, words: int, threshold: tuple[int, int]):
    """Links of one unit as (text, least text of its linked set here, links), and pairs by similarity.

    unit: tree, node and the two blocks. A pair belongs to the first tree in which it meets; one that
    met at depth `before` was compared then. Without texts, only pairs by the agreement of
    their paths are returned.
    """
    none: tuple[list, list, list] = ([], [], [])
    same = unit[2] == unit[3]
    left = np.arange(len(ids)) if same else np.flatnonzero(side == 0)
    right = np.arange(len(ids)) if same else np.flatnonzero(side == 1)
    if len(ids) < 2 or len(left) == 0 or len(right) == 0:
        return none, {}
    todo = ~_meet(paths, left, right, unit[0], depth)
    if before:
        todo &= ~_meet(paths, left, right, TREES, before)
    if same:
        todo &= left[:, None] < right[None, :]
    if not todo.any():
        return none, {}
    num, den = threshold
    if texts is None:
        near = _agreement(paths, left, right)
        near = near[todo & (near * den >= num)]
        return none, dict(zip(*(x.tolist() for x in np.unique((near * BINS).astype(int), return_counts=True)), strict=True))
    sets = exact_sets(texts, words)
    size = np.array([len(s) for s in sets])
    a, b = size[left][:, None], size[right][None, :]
    todo &= np.minimum(a, b) * den >= np.maximum(a, b) * num
    rows, cols = np.flatnonzero(todo.any(axis=1)), np.flatnonzero(todo.any(axis=0))
    if len(rows) == 0:
        return none, {}
    inter = _shared(sets, left[rows], right[cols])
    a, b = size[left[rows]][:, None], size[right[cols]][None, :]
    linked = todo[np.ix_(rows, cols)] & (inter * den >= (a + b - inter) * num)
    x, y = np.nonzero(linked)
    shared = inter[x, y]
    x, y = left[rows[x]], right[cols[y]]
    bins = np.unique(shared * BINS // (size[x] + size[y] - shared), return_counts=True)
    links = np.bincount(x, minlength=len(ids)) + np.bincount(y, minlength=len(ids))
    root = np.arange(len(ids))  # ids are ascending, so the least index is the least text
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    hit = np.flatnonzero(links)
    return (ids[hit].tolist(), ids[root[hit]].tolist(), links[hit].tolist()), dict(zip(*(x.tolist() for x in bins), strict=True))


_UNIT = ["tree", "node", "i", "j"]


def _compare_all(units: DataFrame, depth: int, before: int, words: int, threshold: tuple[int, int]) -> DataFrame:
    """(id, root, links) of all units; a row without id counts the pairs (links) of a similarity (root)."""
    whole = "text" in units.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at, last = (), -1
        out: tuple[list, list, list] = ([], [], [])
        bins: dict[int, int] = {}

        def done() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            paths = np.frombuffer(b"".join(t["paths"].to_pylist()), ">u2").reshape(-1, TREES, DEPTH)
            texts = t["text"].to_pylist() if whole else None
            links, more = compare(t["id"].to_numpy(), t["side"].to_numpy(), paths, texts, at, depth, before, words, threshold)
            for x, y in zip(out, links, strict=True):
                x += y
            for k, n in more.items():
                bins[k] = bins.get(k, 0) + n

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["id", "root", "links"])
            for x in out:
                x.clear()
            return rows

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in _UNIT])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                unit = tuple(keys[:, a].tolist())
                if unit != at:
                    if held:
                        done()
                    at, last = unit, -1
                ids = batch.column("id").to_numpy()[a:b]
                fresh = np.flatnonzero(ids != np.append(last, ids[:-1]))  # repeated rows come once
                last = ids[-1]
                if len(fresh):
                    held.append(batch.slice(int(a), int(b - a)).take(pa.array(fresh)))
            if len(out[0]) > 10_000:
                yield flush()
        if held:
            done()
        for k, n in bins.items():
            for x, v in zip(out, (None, k, n), strict=True):
                x.append(v)
        yield flush()

    return units.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "id").mapInArrow(run, "id long, root long, links long")


def _histogram(rows: DataFrame) -> dict[int, int]:
    """Pairs by similarity, BINS numbers at most."""
    return {r["root"]: r["n"] for r in rows.where("id IS NULL").groupBy("root").agg(F.sum("links").alias("n")).collect()}


def text_key() -> Column:
    """A text's identity: 128 bits of MD5. A null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))


def _nodes_of(texts: DataFrame, depth: int) -> DataFrame:
    """(id, in): for each text the nodes at a depth that it shares with others.

    Nodes with the same members are one, that of the first tree. A node's n texts are dealt
    into as many blocks as keep both texts and bytes of a block in bounds.
    """
    keys = [F.xxhash64(F.lit(t), F.substring("paths", 2 * DEPTH * t + 1, 2 * depth)) for t in range(TREES)]
    leaves = texts.where("paths IS NOT NULL").select("id", "n_bytes", F.posexplode(F.array(*keys)).alias("tree", "node"))
    nodes = leaves.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("n_bytes").alias("bytes"),
        F.min("tree").alias("tree"),
        *(F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"members{i}") for i in (1, 2)),
    )
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.least(F.col("n"), F.ceil(F.col("bytes") / BLOCK_BYTES))).cast("int")
    kept = (
        nodes.where("n > 1")
        .groupBy("members1", "members2", "n")
        .agg(F.min(F.struct("tree", "node", blocks.alias("blocks"))).alias("of"))
        .select("of.*")
    )
    return leaves.select("id", "node").join(kept, "node").groupBy("id").agg(F.collect_list(F.struct("tree", "node", "blocks")).alias("in"))


def _units(placed: DataFrame) -> DataFrame:
    """A row for each unit in which a text of `placed` takes part."""
    carried = [c for c in placed.columns if c != "in"]
    own = F.pmod(F.xxhash64("id", F.lit(3)), F.col("of.blocks")).cast("int")
    spread = placed.withColumn("of", F.explode("in")).withColumn("own", own)
    return spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of.blocks") - 1))).select(
        "of.tree",
        "of.node",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        *carried,
    )


def linked_texts(docs: DataFrame, words: int, threshold: tuple[int, int], recall: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, k) of each document, and (id, k, n_copies, low, n_links, root) of each text.

    low is the least doc_id of the text's documents, root the least id of the texts that
    links connect with this one.
    """
    docs = docs.select("doc_id", text_key().alias("k"), "text")
    rows = stash(signatures(docs, words), "signatures")
    texts = rows.groupBy("k").agg(
        F.count(F.lit(1)).alias("n_copies"), F.min("doc_id").alias("low"), F.max("n_bytes").alias("n_bytes"), F.first("paths").alias("paths")
    )
    texts = stash(texts.withColumn("id", F.monotonically_increasing_id()), "texts")  # numbers hold once they are written
    share = threshold[0] / threshold[1]
    met_whole = _nodes_of(texts, DEPTH).join(texts.select("id", "paths"), "id")
    found = _histogram(_compare_all(_units(met_whole), DEPTH, 0, words, threshold))
    depth, before, compared = shorten(found, DEPTH, share, recall), 0, None
    while True:
        near = _nodes_of(texts, depth).join(texts.select("id", "k", "low", "paths"), "id")
        near = _by_document(near, "low").drop("low")
        here = _by_document(docs, "doc_id").join(near, ["__doc", "__none", "__k"]).select("id", "paths", "text", "in")
        more = stash(_compare_all(_units(here), depth, before, words, threshold), "links")
        compared = more if compared is None else compared.unionByName(more)
        shorter = shorten(_histogram(compared), depth, share, recall)
        if shorter == depth:
            break
        depth, before = shorter, depth
    found = compared.where("id IS NOT NULL")
    links = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "id")
    text = texts.drop("paths", "n_bytes").join(links, "id", "left").join(roots, "id", "left")
    text = text.withColumns({"root": F.coalesce("root", "id"), "n_links": F.coalesce("n_links", F.lit(0))})
    return rows.select("doc_id", "k"), stash(text, "classes")


def _by_document(df: DataFrame, doc: str) -> DataFrame:
    """df with join keys that tell a null doc_id from others, and spread copies of a text."""
    out = df.withColumns({"__doc": F.coalesce(F.col(doc), F.lit(0)), "__none": F.col(doc).isNull()})
    return out.withColumnRenamed("k", "__k")


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = (4, 5), recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_copies, n_links) for each document.

    Texts are linked where their shingle sets have a Jaccard similarity of threshold[0] /
    threshold[1] or more (a tie is a link). class_id is the least doc_id of the documents
    that links and equal texts connect (null if none has an id); n_copies counts the
    documents with this very text, n_links the different texts linked to it. Null and empty
    texts are one text; texts without words are linked to none. Repeated rows are copies.
    No rows give no rows; other columns of docs, whatever their names, are neither read nor
    returned.
    """
    rows, text = linked_texts(docs, words, threshold, recall)
    classes = text.groupBy("root").agg(F.min("low").alias("class_id"))
    text = text.join(classes, "root").select("k", "class_id", "n_copies", "n_links")
    return rows.join(text, "k").drop("k")


def keep_one(docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = (4, 5), recall: float = RECALL) -> DataFrame:
    """The columns of docs for one document of each class: that with the least doc_id.

    Documents without an id stay only where their class has no id; then, and among rows
    repeated with that id, which row stays is arbitrary. No rows give no rows; all columns
    of docs are kept as they are, whatever their names.
    """
    _, text = linked_texts(docs, words, threshold, recall)
    first = F.struct(F.col("low").isNull(), F.col("low"), F.col("k"))
    stays = text.groupBy("root").agg(F.min(first).alias("x")).select("x.k", "x.low")
    keys = ["__doc", "__none", "__k"]
    named = docs.select(
        F.struct("*").alias("row"), text_key().alias("__k"), F.coalesce("doc_id", F.lit(0)).alias("__doc"), F.col("doc_id").isNull().alias("__none")
    )
    return named.join(_by_document(stays, "low").select(*keys), keys, "left_semi").dropDuplicates(keys).select("row.*")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE t AS (SELECT coalesce(text, '') AS text, min(doc_id) AS low, count(*) AS n_copies, row_number() OVER (ORDER BY min(doc_id), coalesce(text, '')) AS k
           FROM documents GROUP BY 1),
w AS (SELECT k, list_filter(string_split_regex(text, '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '') AS w FROM t),
g AS (SELECT DISTINCT k, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT k, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT k, count(*) AS n FROM g GROUP BY k),
c AS (SELECT a.k AS a, b.k AS b, count(*) AS both_have FROM g a JOIN g b ON a.g = b.g AND a.k <> b.k GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.k = a JOIN n y ON y.k = b WHERE 5 * both_have >= 4 * (x.n + y.n - both_have)),
reach AS (SELECT k, k AS other FROM t UNION SELECT reach.k, l.b FROM reach JOIN l ON l.a = reach.other),
classes AS (SELECT reach.k, min(low) AS class_id FROM reach JOIN t ON t.k = reach.other GROUP BY 1),
links AS (SELECT a AS k, count(*) AS n_links FROM l GROUP BY 1)
SELECT doc_id, class_id, n_copies, coalesce(n_links, 0) AS n_links
FROM documents d JOIN t ON t.text = coalesce(d.text, '') JOIN classes USING (k) LEFT JOIN links USING (k)
"""
