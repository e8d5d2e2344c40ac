import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.llm import periodic_runs as pr


def brute_runs(w):
    """Every period in turn: maximal stretches of it, unless a shorter period has the same stretch."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                stretch = w[i : j + q]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found[i, q] = (i, j + q - i, q)
            i = max(j, i + 1)
    return [found[k] for k in sorted(found)]


def brute_row(doc_id, text):
    w = [x for x in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if x]
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = " ".join(x for i, x in enumerate(w) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, left)))


def pieces(rng, letters, n):
    out = []
    while len(out) < n:
        unit = [rng.randrange(letters) for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13]))]
        many = rng.choice([1, 2, 3, 4, 5, 9]) * len(unit) + rng.randrange(len(unit) + 1)
        out += (unit * 12)[:many]
    return out[:n]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(1, 12), st.integers(0, 150))
def test_runs_of_words_equal_brute_force(seed, letters, n):
    w = pieces(random.Random(seed), letters, n)
    assert pr.runs(w) == brute_runs(w)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(1, 30))
def test_the_sieve_keeps_all_runs(seed, letters):
    rng = random.Random(seed)
    texts = [pieces(rng, letters, rng.choice([0, 3, 6, 40, 150])) for _ in range(6)]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    found = [[] for _ in texts]
    last = (-1, 0, 0)
    for k, a, b in pr.candidates(np.array([x for t in texts for x in t], np.int32), offsets):
        assert (k, a) >= (last[0], last[2]) and 0 <= a < b <= len(texts[k])
        last = (k, a, b)
        found[k] += [(a + s, n, q) for s, n, q in pr.runs(texts[k][a:b])]
    assert found == [brute_runs(t) for t in texts]


def test_the_sieve_drops_prose():
    rng = np.random.default_rng(1)
    words = (2000 * rng.random(200_000) ** 3).astype(np.int32)
    assert sum(b - a for _, a, b in pr.candidates(words, np.array([0, 100_000, 200_000]))) < 2000


def test_fibonacci_and_power_words():
    a, b = [0], [0, 1]
    while len(b) < 2000:
        a, b = b, b + a
    assert pr.runs(b[:600]) == brute_runs(b[:600])
    assert pr.runs([0] * 5) == [] and pr.runs([0] * 6) == [(0, 6, 1)]
    assert pr.runs([0, 1] * 4) == [(0, 8, 2)] and pr.runs(([0, 1] * 4)[:7]) == []


def rows_of(df):
    cols = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark, docs, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(f"w{x}é" for x in pieces(rng, rng.choice([2, 9, 60]), rng.choice([1, 5, 80, 200]))) for _ in range(300)]
    texts[:9] = [None, "", " \t\n", "\x0b a\x0c\ra  a\ta a a\n", "a\xa0a " * 6, "a b " * 7, "x", "é é é é é é", "\x1fa " * 9]
    rows = [*enumerate(texts), (7, texts[7]), (None, "b b b b b b b"), (-5, "c " * 50)]
    df = docs(*rows).withColumns({"runs": F.lit(1), "a.b": F.lit("x"), "best": F.lit(3), "collapsed": F.lit(0)})
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(pr.op12_periodic_runs(spark, str(tmp_path))) == sorted((brute_row(*r) for r in rows), key=repr)


def test_no_rows(spark, docs, tmp_path):
    docs().write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(pr.op12_periodic_runs(spark, str(tmp_path))) == []


def test_query_on_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    short = {i: t for i, t in rows if len(t or "") < 3000}
    got = [r for r in rows_of(pr.op12_periodic_runs(spark, sf_dir)) if r[0] in short]
    assert got == sorted((brute_row(i, t) for i, t in short.items()), key=repr)


def test_a_long_periodic_text(spark, docs):
    unit = [f"word{i}" for i in range(20_000)]
    text = " ".join(unit * 10)
    row = pr.find_runs(docs((1, text))).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 200_000, 20_000)] and row["collapsed"] == " ".join(unit)
