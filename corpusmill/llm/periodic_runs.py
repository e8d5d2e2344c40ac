"""Periodic runs of words by a suffix automaton and access to its link tree.

A run is a stretch of consecutive words that repeats its first q words (q its smallest period)
four times or more and that no neighbouring word extends.

The automaton is grown word by word. Its link tree holds, on the path from the state of a prefix to the root,
all suffixes of this prefix. A state's colour is the last place where its words ended. When the
word at i is appended, the path of its prefix is recoloured to i, and each segment of one old
colour e is met with the length of its longest words: where i - e is within that length, the
words up to e and up to i are equal and meet, so that a square of period i - e ends at i. The
periods met this way are primitive: a square of a shorter period at i would have been the
later occurrence. In a run of period q a square of period q ends at each place from 2q - 1 on,
hence consecutive places of one period are a run, whole and without duplicates.

All words of a stretch are known when it is read, so the tree may be that of the whole
stretch, which stands still: its paths are kept as heavy paths, each with a stack of
coloured segments, in place of splay trees that are cut and linked again. An access pops the
segments that it recolours, and meets a logarithm of heavy paths at most.

Before that, a sieve over many documents at once leaves out words that can't be in a run: in
a run of period q, all groups of GRAM words but the first q have a copy q places earlier.
A stretch of c such places in a row bounds q, and places whose last copy is farther away cut the stretch.
The sieve compares hashes and so may only leave too much in; the automaton compares words.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import bind
from corpusmill.llm.common import chunks, table, utf8

EXPONENT = 4  # repetitions in a run, at least
SHORTEST = 6  # words in a run, at least
GRAM = 4  # words compared by the sieve
ROUNDS = 64  # of the sieve at most; what is left then goes to the automaton

_FACTORS = np.random.default_rng(12).integers(1, 1 << 63, GRAM + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def candidates(words: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches (document, first word, end) outside of which no run has a word.

    words: numbers of words, those of document k from offsets[k] to offsets[k + 1]. Stretches of a
    document ascend and don't overlap.
    """
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(np.arange(len(words)) + GRAM <= offsets[1:][of])
    if len(at) == 0:
        return []
    key = of[at].astype(np.uint64) * _FACTORS[GRAM]
    for k in range(GRAM):
        key += words[at + k].astype(np.uint64) * _FACTORS[k]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    back = np.full(len(at), len(words) + 1)
    back[order[1:][same]] = (at[order[1:]] - at[order[:-1]])[same]
    # A run of period q leaves max(SHORTEST, EXPONENT * q) - q - GRAM + 1 places in a row, each with a copy within q.
    left = np.flatnonzero(back <= len(words))
    first = size = bound = np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        if len(left) == 0:
            return []
        first = np.flatnonzero(np.concatenate([[True], at[left[1:]] != at[left[:-1]] + 1]))
        size = np.diff(np.append(first, len(left)))
        bound = (size + GRAM - 1) // (EXPONENT - 1)
        bound[size < max(1, SHORTEST - GRAM)] = 0
        keep = back[left] <= np.repeat(bound, size)
        if keep.all():
            break
        left = left[keep]
    else:
        first = np.flatnonzero(np.concatenate([[True], at[left[1:]] != at[left[:-1]] + 1]))
        size = np.diff(np.append(first, len(left)))
        bound = (size + GRAM - 1) // (EXPONENT - 1)
    if len(left) == 0:
        return []
    x = at[left[first]]
    doc = of[x]
    a, b = np.maximum(x - bound, offsets[doc]) - offsets[doc], x + size + GRAM - 1 - offsets[doc]
    out: list[tuple[int, int, int]] = []
    for d, i, j in zip(doc.tolist(), a.tolist(), b.tolist(), strict=True):
        while out and out[-1][0] == d and i < out[-1][2]:
            _, k, m = out.pop()
            i, j = min(i, k), max(j, m)
        out.append((d, i, j))
    return out


class Automaton:
    """Suffix automaton of a sequence of numbers, in arrays of a few bytes a state.

    The first transition of a state is kept in two arrays, others in a dict for the state. prefix[i]
    is the state of the first i + 1 words.
    """

    def __init__(self, seq):
        self.length, self.link = array("i", [0]), array("i", [-1])
        self.word, self.to = array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}
        self.prefix = array("i")
        last = 0
        for w in seq:
            last = self._append(last, w)
            self.prefix.append(last)

    def _state(self, length: int, link: int, word: int, to: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.word.append(word)
        self.to.append(to)
        return len(self.length) - 1

    def _append(self, last: int, w: int) -> int:
        link, word, to, more = self.link, self.word, self.to, self.more
        new = self._state(self.length[last] + 1, 0, -1, 0)
        p, q = last, -1
        while p >= 0:
            if word[p] < 0:
                word[p], to[p] = w, new
            elif word[p] == w:
                q = to[p]
                break
            elif p not in more:
                more[p] = {w: new}
            elif w in more[p]:
                q = more[p][w]
                break
            else:
                more[p][w] = new
            p = link[p]
        if p >= 0:
            link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        link, word, to, more = self.link, self.word, self.to, self.more
        c = self._state(self.length[p] + 1, link[q], word[q], to[q])
        if q in more:
            more[c] = dict(more[q])
        link[q] = c
        while p >= 0:
            if word[p] == w and to[p] == q:
                to[p] = c
            elif word[p] != w and more.get(p, {}).get(w) == q:
                more[p][w] = c
            else:
                break
            p = link[p]
        return c

    def heads(self) -> list[int]:
        """For each state the first state of its heavy path in the link tree."""
        link, n = self.link.tolist(), len(self.link)
        down = np.argsort(-np.frombuffer(self.length, np.int32), kind="stable").tolist()
        size, heavy = [1] * n, [-1] * n
        for v in down[:-1]:
            p = link[v]
            size[p] += size[v]
            if heavy[p] < 0 or size[v] > size[heavy[p]]:
                heavy[p] = v
        head = [0] * n
        for v in reversed(down[:-1]):
            p = link[v]
            head[v] = head[p] if heavy[p] == v else v
        return head


def squares(seq) -> Iterator[tuple[int, int]]:
    """(end, period) of squares: for each end, a primitive period of every kind of square that ends there."""
    automaton = Automaton(seq)
    length, link, head = automaton.length, automaton.link, automaton.heads()
    #: Segments of a heavy path as (length of the deepest state, colour), the deepest first.
    paths: dict[int, list[tuple[int, int]]] = {}
    for i, v in enumerate(automaton.prefix):
        while v > 0:
            top, deep = head[v], length[v]
            segments = paths.get(top)
            if segments is None:
                paths[top] = [(deep, i)]
            else:
                reach = 0
                while segments and segments[-1][0] <= deep:
                    reach, colour = segments.pop()
                    if i - colour <= reach:
                        yield i, i - colour
                # The next segment goes on below this state; its part above is recoloured.
                if segments and reach < deep and i - segments[-1][1] <= deep:
                    yield i, i - segments[-1][1]
                segments.append((deep, i))
            v = link[top]


def runs(seq) -> list[tuple[int, int, int]]:
    """All runs of a sequence of numbers as (start, length, period), by start, then period."""
    found = []
    open_runs: dict[int, tuple[int, int]] = {}

    def close(period: int, first: int, last: int) -> None:
        start = first - 2 * period + 1
        if last + 1 - start >= max(SHORTEST, EXPONENT * period):
            found.append((start, last + 1 - start, period))

    for i, period in squares(seq):
        first, last = open_runs.get(period, (i, i))
        if last < i - 1:
            close(period, first, last)
            first = i
        open_runs[period] = (first, i)
    for period, (first, last) in open_runs.items():
        close(period, first, last)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run contains after its first period, joined by spaces."""
    if found:
        stays = np.ones(len(words), bool)
        for start, length, period in found:
            stays[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(stays).tolist()]
    return b" ".join(words)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

Reword = Callable[[int | None, list[bytes]], list[bytes]]


def find_runs(docs: DataFrame, reword: Reword | None = None) -> DataFrame:
    """doc_id, runs (start, length, period; in words) and collapsed (the text without repetitions).

    Words are parted by ASCII white space. reword(doc_id, words) may put other words in their
    place before the search. A null or empty text has no words, no runs and an empty result.
    Each row is searched by itself: repeated rows have equal results, no rows give no rows,
    and columns other than doc_id and text are not read. Texts are searched whole; what one takes in memory
    is some 100 bytes for each word that may be in a run.
    """

    def search(docs: list, texts: list[bytes]) -> tuple[list, list]:
        seqs = [x.split() for x in texts]
        if reword is not None:
            seqs = [reword(i, x) for i, x in zip(docs, seqs, strict=True)]
        number: dict[bytes, int] = {}
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in seqs])]).astype(np.int64)
        words = np.fromiter((number.setdefault(w, len(number)) for w in chain.from_iterable(seqs)), np.int32, offsets[-1])
        found: list[list] = [[] for _ in seqs]
        for k, a, b in candidates(words, offsets):
            part = words[offsets[k] + a : offsets[k] + b].tolist()
            found[k] += [(a + start, length, period) for start, length, period in runs(part)]
        return found, [collapsed(x, r) for x, r in zip(seqs, found, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column("text"))
            for a, b in chunks(offsets):
                part = batch.column("doc_id").slice(a, b - a)
                texts = [raw[i:j].tobytes() for i, j in zip(offsets[a:b], offsets[a + 1 : b + 1], strict=True)]
                found, left = search(part.to_pylist(), texts)
                rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in found]
                cols = [part, pa.array(rows, _RUNS), pa.array(left, pa.binary()).cast(pa.string(), safe=False)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """In a tenth of the documents, the words from a place on repeat a few of them, as op12 asks for.

    A document without an id keeps its words.
    """
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or n == 0:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def longest(found: Column) -> Column:
    """The run with the most repetitions, exactly; the first of equals. Null if there is none."""
    more = lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best)
    return bind(found, lambda x: F.aggregate(x, F.try_element_at(x, F.lit(1)), more))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(table(spark, sf_dir, "documents"), repeated_tail).withColumn("best", longest(F.col("runs")))
    rows = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(rows, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
