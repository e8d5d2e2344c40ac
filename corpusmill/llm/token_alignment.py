"""Alignment of two tokenizers' tokens by merge-path partitioning.

The ends of the A tokens and of the B tokens of a text are two ascending lists. Merging them
finds which tokens overlap, and where both end groups are cut. A diagonal of the merge
holds all splits of a given number of steps; a binary search on it finds the one that the
merge passes. Diagonals at equal distances so cut the merge of a whole chunk of documents into
pieces of equal work, however its tokens are dealt to documents, and each piece emits the overlaps
of its own ends. A token that spans two pieces is known to both; running numbers of the common
ends join what pieces have of a group.

Counts of id pairs are those of the whole corpus, and are neither collected nor broadcast. A
chunk of documents writes its different pairs with their counts once, and for each document a sparse vector
over these pairs. Spark adds the counts up by pair, joins the sums to the chunks' pairs and
brings them to the chunks' vectors. A chunk has a fixed size, so that the work and the rows
are proportional to the corpus and a group never holds more than a chunk; the most frequent pair is
one row of a chunk.

Texts are cut before spaces that follow a letter or sign, where neither tokenizer has a token
across the cut (`Pair` makes sure of that), so that a worker encodes each different stretch once.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import chunks, stash, table, utf8

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_BYTES = 2 << 20  # of text, or one longer document in pieces of that size
PIECE = 1 << 16  # steps of the merge in a piece
KEPT_IDS = 1_500_000  # ids that a worker keeps of stretches it has seen
LONG = 500  # letters of a stretch that goes to the slower encoder, whose time doesn't grow with the square

# Fixed value: how the byte-level tokenizer splits texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CUT = re.compile(r"(?<=\S)(?= )")
_ODD = re.compile(r"\s ")
_MARK = "▁"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is visible, else from U+0100 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in seen)}


class Pair:
    """Both tokenizers: the ids of stretches, and the bytes of each id."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        self._whole = Tokenizer.from_str(json.dumps(spec))
        self._whole.encode_special_tokens = True
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocab.items()}
        pre = spec["pre_tokenizer"]
        if not (pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]):
            raise ValueError(f"{a_path} does not split texts as expected")
        merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["model"]["merges"]]
        # Merges whose order is that of the ids can be done by rank, several times as fast.
        by_rank = merged == list(range(256, 256 + len(merged)))
        self._fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if by_rank else None
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        if any(re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces):
            raise ValueError(f"{b_path} has pieces that go on after a space")
        # B adds no space to an empty stretch, which is the last space of a text.
        self._space = [self._b.piece_to_id(_MARK)]
        if self._b.is_unknown(self._space[0]):
            raise ValueError(f"{b_path} has no piece for a space")
        byte = lambda i: bytes([int(pieces[i][3:5], 16)]) if self._b.is_byte(i) else pieces[i].replace(_MARK, " ").encode()
        self.b_bytes = [byte(i) for i in range(len(pieces))]
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.a_size, self.b_size = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        self._forget()

    def _forget(self) -> None:
        self._number: dict[str, int] = {}
        none = np.zeros(0, np.int32)
        self._ids, self._ends, self._right = [none, none], [np.zeros(1, np.int64)] * 2, np.zeros(0, bool)

    def _a(self, stretch: str) -> list[int]:
        if self._fast is None or len(stretch) > LONG:
            return self._whole.encode(" " + stretch, add_special_tokens=False).ids
        return self._fast.encode_ordinary(" " + stretch)

    def encode(self, stretches: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """ids, tokens of each stretch (both for A and B), and whether both give the stretch's bytes back.

        A stretch stands for itself with a space before it.
        """
        if len(self._ids[0]) > KEPT_IDS:
            self._forget()
        number = self._number
        new = [x for x in dict.fromkeys(stretches) if x not in number]
        for first in range(0, len(new), 10_000):
            part = new[first : first + 10_000]
            a, b = [self._a(x) for x in part], [x or self._space for x in self._b.encode(part, num_threads=1)]
            right = [
                b"".join([self.a_bytes[i] for i in x]) == raw == b"".join([self.b_bytes[i] for i in y])
                for x, y, raw in ((x, y, b" " + s.encode()) for x, y, s in zip(a, b, part, strict=True))
            ]
            for side, ids in enumerate((a, b)):
                flat = np.fromiter(chain.from_iterable(ids), np.int32)
                ends = self._ends[side][-1] + np.cumsum([len(x) for x in ids])
                self._ids[side] = np.concatenate([self._ids[side], flat])
                self._ends[side] = np.concatenate([self._ends[side], ends])
            self._right = np.concatenate([self._right, right])
            number.update(zip(part, range(len(number), len(number) + len(part)), strict=True))
        k = np.fromiter(map(number.__getitem__, stretches), np.int64, len(stretches))
        out, sizes = [], []
        for ids, ends in zip(self._ids, self._ends, strict=True):
            size = ends[k + 1] - ends[k]
            out.append(ids[np.repeat(ends[k] - np.cumsum(size) + size, size) + np.arange(size.sum())])
            sizes.append(size)
        return out, sizes, self._right[k]


@lru_cache(maxsize=1)
def load(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def stretches(text: str) -> list[str]:
    """The text with a space before it, cut before each space that follows no white space; without that space."""
    if not text:
        return []
    if text[0] == " " or _ODD.search(text):
        return [x[1:] for x in _CUT.split(" " + text)]
    return text.split(" ")


def merge_path(a: np.ndarray, b: np.ndarray, steps: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two ascending lists stands after every `steps` steps, from start to end; of equals a comes first."""
    d = np.append(np.arange(0, len(a) + len(b), steps), len(a) + len(b))
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (on := np.flatnonzero(low < high)).size:
        mid = (low[on] + high[on]) // 2
        before = a[mid] <= b[d[on] - 1 - mid]
        low[on[before]] = mid[before] + 1
        high[on[~before]] = mid[~before]
    return low, d - low


def overlaps(a: np.ndarray, b: np.ndarray, steps: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """For each A end the B token that reaches it, and for each B end the A token, piece by piece.

    a and b are ascending ends with equal last ones.
    """
    i, j = merge_path(a, b, steps)
    of_a, of_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    for i0, i1, j0, j1 in zip(i[:-1], i[1:], j[:-1], j[1:], strict=True):
        of_a[i0:i1] = j0 + np.searchsorted(b[j0:j1], a[i0:i1])
        # The A end before the piece may equal its first B end.
        k = max(i0 - 1, 0)
        of_b[j0:j1] = k + np.searchsorted(a[k:i1], b[j0:j1])
    return of_a, of_b


_DIGITS = np.zeros((100_000, 5), np.uint8)
for _k in range(5):
    _DIGITS[:, _k] = np.arange(100_000) // 10 ** (4 - _k) % 10 + 48
    _DIGITS[: 10 ** (4 - _k) if _k < 4 else 0, _k] = 0


def group_texts(a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, doc_ends: np.ndarray) -> list[bytes]:
    """Groups as text for each document: `a1,a2|b1;a3|b2,b3`.

    a, b: ids; a_last, b_last: numbers of the last tokens of each group; doc_ends: numbers of groups up to each document's end.
    """
    group_of = lambda last, n: np.searchsorted(last, np.arange(n))
    a_at = np.arange(len(a)) + np.concatenate([[0], b_last + 1])[group_of(a_last, len(a))]
    b_at = np.arange(len(b)) + (a_last + 1)[group_of(b_last, len(b))]
    cells = np.empty((len(a) + len(b), 6), np.uint8)
    cells[a_at, :5], cells[b_at, :5] = _DIGITS[a], _DIGITS[b]
    cells[:, 5] = ord(",")
    cells[a_at[a_last], 5] = ord("|")
    last = b_at[b_last]
    cells[last, 5] = ord(";")
    ends = last[doc_ends[doc_ends > 0] - 1]
    cells[ends, 5] = 0
    full = cells != 0
    upto = np.concatenate([[0], np.cumsum(np.count_nonzero(full, axis=1))])
    raw = cells[full].tobytes()
    cuts = np.zeros(len(doc_ends) + 1, np.int64)
    cuts[1:][doc_ends > 0] = upto[ends + 1]
    cuts = np.maximum.accumulate(cuts)
    return [raw[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _pack(values: np.ndarray) -> bytes:
    """Numbers below 2^32, byte by byte of all of them, so that the rare high bytes compress."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: pa.Scalar) -> np.ndarray:
    raw = np.frombuffer(data.as_buffer(), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4")[:, 0].astype(np.int64)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
#: Rows of documents, and one row a chunk with its pairs (ascending codes, and how often each is linked).
_ENCODED = pa.schema(
    [("chunk", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS)]
    + [("groups", pa.string()), ("at", pa.binary()), ("times", pa.binary()), ("codes", pa.binary()), ("counts", pa.binary())]
)


def align_chunk(texts: list[str], pair: Pair, steps: int = PIECE) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
    """For each text the columns of a document's row; the chunk's pair codes and their counts."""
    n = len(texts)
    parts = [stretches(x) for x in texts]
    per = np.array([len(x) for x in parts], np.int64)
    (a, b), (a_size, b_size), right = pair.encode(list(chain.from_iterable(parts)))
    of = np.repeat(np.arange(n), per)
    whole = np.bincount(of, ~right, n) == 0
    keep = whole[of]
    if not keep.all():
        a, b = a[np.repeat(keep, a_size)], b[np.repeat(keep, b_size)]
        of, a_size, b_size = of[keep], a_size[keep], b_size[keep]
    n_a, n_b = (np.bincount(of, s, n).astype(np.int64) for s in (a_size, b_size))
    a_ends, b_ends = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
    of_a, of_b = overlaps(a_ends, b_ends, steps)
    a_common, b_common = b_ends[of_a] == a_ends, a_ends[of_b] == b_ends
    a_last, b_last = np.flatnonzero(a_common), np.flatnonzero(b_common)
    a_doc, b_doc = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    n_groups = np.bincount(a_doc[a_last], minlength=n)
    # Each end is a link of the tokens that reach it; a common end is one link.
    inner = np.flatnonzero(~b_common)
    codes = np.concatenate([a.astype(np.int64) * len(pair.b_bytes) + b[of_a], a[of_b[inner]].astype(np.int64) * len(pair.b_bytes) + b[inner]])
    doc = np.concatenate([a_doc, b_doc[inner]])
    kinds, which = np.unique(codes, return_inverse=True)
    counts = np.bincount(which, minlength=len(kinds))
    keys, times = np.unique(doc * max(len(kinds), 1) + which, return_counts=True)
    key_doc, at = np.divmod(keys, max(len(kinds), 1))
    cuts = np.searchsorted(key_doc, np.arange(n + 1)).tolist()
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    step = np.diff(at, prepend=0)
    begin = np.array([x for x, y in spans if x < y], np.int64)
    step[begin] = at[begin]
    cols = {
        "n_a": n_a.tolist(),
        "n_b": n_b.tolist(),
        "n_groups": n_groups.tolist(),
        "n_links": (n_a + n_b - n_groups).tolist(),
        "groups": group_texts(a, b, a_last, b_last, np.cumsum(n_groups) * (n_groups > 0)),
        "at": [_pack(step[x:y]) for x, y in spans],
        "times": [_pack(times[x:y]) for x, y in spans],
    }
    return cols, kinds, counts


def pieces(text: str, most: int) -> Iterator[str]:
    """A long text in pieces of about `most` letters, cut where `stretches` cuts; the space at a cut belongs to the next piece."""
    start = 0
    while cut := _CUT.search(text, start + most):
        if cut.start() == len(text) - 1:
            break  # a lone space is no piece
        yield text[start : cut.start()]
        start = cut.start() + 1
    yield text[start:]


def align_long(text: str, pair: Pair, most: int) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
    """What `align_chunk` gives for one text, which is aligned piece by piece: tokens of both end at every cut."""
    total, groups = dict.fromkeys(_COUNTS, 0), []
    kinds, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for piece in pieces(text, most):
        cols, k, n = align_chunk([piece], pair)
        if not cols["n_a"][0]:
            return align_chunk([""], pair)  # tokens that don't give the text back
        for c in _COUNTS:
            total[c] += cols[c][0]
        groups += cols["groups"]
        kinds, which = np.unique(np.concatenate([kinds, k]), return_inverse=True)
        both = np.zeros(len(kinds), np.int64)
        np.add.at(both, which, np.concatenate([counts, n]))
        counts = both
    step = np.ones(len(kinds), np.int64)
    step[:1] = 0
    return {**{c: [v] for c, v in total.items()}, "groups": [b";".join(groups)], "at": [_pack(step)], "times": [_pack(counts)]}, kinds, counts


def encoded(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int) -> DataFrame:
    """The rows of _ENCODED for documents, chunk by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(a_path, b_path)
        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            for x, y in chunks(offsets, chunk_bytes):
                ids, texts = batch.column("doc_id").slice(x, y - x), batch.column("text").slice(x, y - x)
                rows = [t or "" for t in texts.to_pylist()]
                long = offsets[y] - offsets[x] > chunk_bytes  # one document
                cols, kinds, counts = align_long(rows[0], pair, chunk_bytes) if long else align_chunk(rows, pair)
                name = uuid.uuid4().int >> 65
                n = y - x
                put = {"chunk": [name] * (n + 1), "doc_id": [*ids.to_pylist(), None]}
                put |= {c: [*v, None] for c, v in cols.items()}
                put["codes"], put["counts"] = [None] * n + [kinds.astype("<i8").tobytes()], [None] * n + [counts.astype("<i8").tobytes()]
                arrays = [pa.array(put[f.name], pa.binary() if f.name == "groups" else f.type).cast(f.type) for f in _ENCODED]
                yield pa.RecordBatch.from_arrays(arrays, schema=_ENCODED)

    kinds = "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, at binary, times binary, codes binary, counts binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kinds)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each pair of a chunk."""
    for batch in batches:
        for name, codes, counts in zip(*(batch.column(c) for c in ("chunk", "codes", "counts")), strict=True):
            code, count = (np.frombuffer(x.as_buffer(), "<i8") for x in (codes, counts))
            for k in range(0, len(code), 50_000):
                part = pa.array(code[k : k + 50_000])
                same = pa.array(np.full(len(part), name.as_py()))
                yield pa.RecordBatch.from_arrays([same, part, pa.array(count[k : k + 50_000])], ["chunk", "code", "n"])


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"


def _weigh(key: tuple, docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums of the pairs' counts for each document of a chunk."""
    order = np.argsort(pairs["code"].to_numpy())
    n, best = pairs["n"].to_numpy()[order], pairs["best"].to_numpy(zero_copy_only=False)[order]
    n_best, count_sum = [], []
    for at, times in zip(docs["at"], docs["times"], strict=True):
        k, m = np.cumsum(_unpack(at)), _unpack(times)
        n_best.append(int(m[best[k]].sum()))
        count_sum.append(int((m * n[k]).sum()))
    kept = docs.drop_columns(["chunk", "at", "times"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def align(
    docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH, digest: bool = False, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups of each document.

    A encodes the text with a space before it, B the text, to which it adds the space itself.
    Groups end where tokens of both end, as text `a1,a2|b1;a3|b2,b3` of ids; with `digest` there is
    groups_sha256 in place of it. Links are pairs of overlapping tokens; count_sum adds up how often
    the id pair of each link is linked in all documents, and n_best counts links whose pair is as
    frequent as any with its B id.

    Null and empty texts, and those whose tokens don't give them back (a text that holds U+2581),
    have no tokens: zeros and no groups. Repeated rows count each; no rows give no rows; other columns
    are not read. A text is encoded whole, however long. Both paths must be readable on all executors.
    """
    rows = encoded(docs, a_path, b_path, chunk_bytes)
    groups = "groups"
    if digest:
        groups = "groups_sha256"
        rows = rows.withColumn(groups, F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
    rows = stash(rows, "aligned")
    pairs = rows.where("codes IS NOT NULL").select("chunk", "codes", "counts").mapInArrow(_pairs, "chunk long, code long, n long")
    sums = stash(pairs.groupBy("code").agg(F.sum("n").alias("n")), "pair-counts")
    b_id = F.col("code") % len(load(a_path, b_path).b_bytes)
    most = sums.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    sums = sums.withColumn("b", b_id).join(most, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    found = pairs.select("chunk", "code").join(sums, "code")
    of_docs = rows.where("codes IS NULL").select("chunk", "doc_id", *_COUNTS, groups, "at", "times")
    schema = _RESULT.replace("n_best", f"{groups} string, n_best")
    return of_docs.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_weigh, schema)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), digest=True)
