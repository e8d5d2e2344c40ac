import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.llm import jaccard
from corpusmill.llm import suffix_dedup as sd
from corpusmill.llm.components import components


def brute_removal(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(r), len(r) - len(kept), spans, kept))
    return out


def removed(df, **options):
    rows = sd.remove_repeats(df, **options).collect()
    return sorted((r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows)


def make_texts(seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    line, line2 = noise(150), noise(60)
    texts = [noise(rng.randint(0, 300)) + rng.choice([line, line2, line[:70], line[40:] + line2]) + noise(50) for _ in range(25)]
    return [*texts, None, "", "x" * 300, "xy" * 90, noise(40), texts[0], texts[0], line, noise(60_000) + line]


@pytest.mark.parametrize("hot", [1000, 1])
def test_suffix_dedup_equals_brute_force(spark, docs, hot):
    texts = make_texts(3)
    df = docs(*((i if i % 7 else None, t) for i, t in enumerate(texts))).withColumn("spans", F.lit("x")).withColumn("k", F.lit(1))
    assert removed(df, length=64, hot=hot) == sorted(brute_removal(texts, 64))


def test_suffix_dedup_repeated_rows_and_empty(spark, docs):
    text = " ".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(8))
    assert removed(docs((1, text), (1, text))) == [(len(text), len(text), 1, b"")] * 2
    assert removed(docs((1, text))) == [(len(text), 0, 0, text.encode())]
    assert removed(docs()) == []


def colliding_texts():
    """Two texts of 252 letters that share no string of 200 bytes, but whose hashes by prefix sums are equal.

    Blocks of 64 letters a and b in the order of Thue and Morse differ from those with a and b exchanged by
    (a - b) times a constant with many zero bits; three such blocks are chosen so that the rest cancels out.
    """
    power = [int(x) for x in sd.powers(256)[0][:256]]
    order = [bin(i).count("1") & 1 for i in range(64)]
    unit = sum(power[i] * (1 - 2 * t) for i, t in enumerate(order))
    letters = [c for c in range(33, 127)]
    pairs = [(x, y) for x in letters for y in letters if x != y and (int(sd.BYTE[x]) - int(sd.BYTE[y])) % 4 == 0]
    value = np.array([(int(sd.BYTE[x]) - int(sd.BYTE[y])) * unit % 2**64 for x, y in pairs], np.uint64)
    places = (0, 124, 188)
    one, two, three = (value * np.uint64(power[k]) for k in places)
    for k, v in enumerate(three):
        hit = np.flatnonzero(np.isin((~v + np.uint64(1)) - one, two))
        if len(hit):
            i = int(hit[0])
            j = int(np.flatnonzero(two == (~v + np.uint64(1)) - one[i])[0])
            chosen = pairs[i], pairs[j], pairs[k]
            break
    block = lambda p, turn: "".join(chr(p[t ^ turn]) for t in order)
    rng = random.Random(0)
    while True:
        shared = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(60))
        texts = [block(chosen[0], t) + shared + block(chosen[1], t) + block(chosen[2], t) for t in (0, 1)]
        found = [sd.runs(np.frombuffer(t.encode(), np.uint8), np.array([0, 252])) for t in texts]
        if all(len(f[0]) == 1 for f in found) and found[0][1] == found[1][1] and found[0][2] == found[1][2]:
            return texts


def test_texts_made_to_collide_are_no_repeats(spark, docs):
    texts = colliding_texts()
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    a, b = (sd.Prefix(r).of(np.array([0]), np.array([252]))[0] for r in raw)
    assert a == b and all(x != y for x, y in zip(*(t[:64] for t in texts), strict=True))
    for hot in (1000, 1):
        assert removed(docs(*enumerate(texts)), hot=hot) == sorted((252, 0, 0, t.encode()) for t in texts)
        more = [*texts, texts[0]]
        assert removed(docs(*enumerate(more)), hot=hot) == sorted(brute_removal(more, 200))


def test_windows_whose_digits_collide_are_compared(spark, monkeypatch):
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 100, 90).astype(np.uint8)) for _ in range(30)]
    texts += [texts[0], texts[1][3:] + b"abc", texts[2][:70]]
    group, weight = np.arange(len(texts)) % 2, np.ones(len(texts), np.int64)
    monkeypatch.setattr(sd.Prefix, "of", lambda self, s, e: np.zeros(len(s), np.uint64))
    seen = Counter((g, t[i : i + 64]) for g, t in zip(group, texts, strict=True) for i in range(len(t) - 63))
    first, last = sd.repeated(group, weight, texts, 64)
    for k, t in enumerate(texts):
        at = [i for i in range(len(t) - 63) if seen[group[k], t[i : i + 64]] > 1]
        assert (first[k], last[k]) == ((at[0], at[-1]) if at else (-1, -1))


def test_query_at_its_own_length(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert removed(docs) == sorted(brute_removal([r["text"] for r in docs.collect()], sd.LENGTH))


def brute_classes(texts, words=5):
    """class (least position), links and copies of each text."""
    sets = {}
    for t in texts:
        w = (t or "").split()
        sets[t or ""] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    keys = list(sets)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = Counter()
    for i, a in enumerate(keys):
        for b in keys[:i]:
            n = len(sets[a] & sets[b])
            if n and 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    low = {}
    for i, t in enumerate(texts):
        low.setdefault(find(t or ""), i)
    copies = Counter(t or "" for t in texts)
    return [(i, low[find(t or "")], copies[t or ""], links[t or ""]) for i, t in enumerate(texts)]


def near_texts(seed, families=6, members=12):
    rng = random.Random(seed)
    out = []
    for _ in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(4, 160))]
        for _ in range(members):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = f"w{rng.randrange(400)}"
            out.append(" ".join(w))
    return [*out, None, "", " ", "one", "one two three", "one two three", out[0], out[0].replace(" ", "\n")]


@pytest.mark.parametrize("block", [256, 3])
def test_jaccard_equals_brute_force(spark, docs, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    texts = near_texts(5)
    df = docs(*enumerate(texts)).withColumn("k", F.lit("x")).withColumn("root", F.lit(1))
    got = sorted((r["doc_id"], r["class_id"], r["n_copies"], r["n_links"]) for r in jaccard.near_duplicates(df).collect())
    assert got == brute_classes(texts)
    kept = jaccard.keep_one(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _, _ in brute_classes(texts)})
    assert kept.columns == df.columns


def test_prefix_is_shortened_by_what_is_met():
    assert jaccard.shorten({99: 100_000}, 8, 0.8, 0.999) == 8
    assert jaccard.shorten({80: 100_000}, 8, 0.8, 0.999) == 6
    assert jaccard.shorten({}, 8, 0.8, 0.999) == 6
    assert jaccard.shorten({90: 50_000, 80: 50_000}, 8, 0.8, 0.99999) == 4
    assert jaccard.recall_at({}, 8, 8, 0.8) == jaccard.met(0.8, 8)


def with_similarity(rng, shared, own, n):
    """Pairs of texts that share `shared` of `shared + 2 * own` shingles."""
    out = []
    for _ in range(n):
        base = [f"v{rng.randrange(10**6)}" for _ in range(shared + own + 4)]
        other = [f"u{rng.randrange(10**6)}" for _ in range(own)]
        out.append((" ".join(base), " ".join(base[: shared + 4] + other)))
    return out


@pytest.mark.parametrize("shared,own", [(80, 10), (85, 8), (90, 5)])
def test_recall_of_planted_pairs(spark, docs, shared, own):
    pairs = with_similarity(random.Random(shared), shared, own, 300)
    rows = [(2 * i + j, t) for i, pair in enumerate(pairs) for j, t in enumerate(pair)]
    got = {r["doc_id"]: r for r in jaccard.near_duplicates(docs(*rows)).collect()}
    assert sum(got[2 * i + 1]["class_id"] == 2 * i and got[2 * i]["n_links"] == 1 for i in range(300)) == 300
    far = with_similarity(random.Random(shared), 79, 11, 300)
    rows = [(2 * i + j, t) for i, pair in enumerate(far) for j, t in enumerate(pair)]
    assert all(r["n_links"] == 0 for r in jaccard.near_duplicates(docs(*rows)).collect())


def test_words_made_to_collide_are_no_links(spark, docs):
    """Thue-Morse words have equal polynomial hashes modulo a power of two."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    b = a.translate(str.maketrans("ab", "ba"))
    assert [r["n_links"] for r in jaccard.near_duplicates(docs((1, a), (2, b))).collect()] == [0, 0]


def test_jaccard_edges(spark, docs):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (None, text), (None, "other " + text), (3, text + " x"), (9, "alone"), (9, "alone")]
    got = jaccard.near_duplicates(docs(*rows)).collect()
    assert len(got) == 6 and {r["class_id"] for r in got} == {3, 9}
    assert sorted(r["doc_id"] for r in jaccard.keep_one(docs(*rows)).collect()) == [3, 9]
    assert [r["class_id"] for r in jaccard.near_duplicates(docs((None, "a"))).collect()] == [None]
    assert jaccard.keep_one(docs((None, "a"), (None, "a"))).count() == 1
    assert jaccard.near_duplicates(docs()).collect() == [] and jaccard.keep_one(docs()).collect() == []


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for v in sorted(near):
        stack = [v]
        while stack:
            u = stack.pop()
            if u not in want:
                want[u] = v
                stack += near[u]
    assert got == want


def test_components_of_a_chain(spark):
    df = spark.range(200).selectExpr("id * 7 % 1009 AS a", "(id + 1) * 7 % 1009 AS b")
    assert {r["root"] for r in components(df).collect()} == {min(i * 7 % 1009 for i in range(201))}


def test_copies_send_one_run_of_each_kind(spark, docs):
    text = " ".join(random.Random(4).choices([f"w{i}" for i in range(500)], k=200))
    rows = [(i, text) for i in range(40)] + [(0, text)] * 5 + [(99, text[:450] + "#" + text[450:])]
    d = docs(*rows).select("doc_id", F.xxhash64("text").alias("k"), "text")
    sent = sd.marked_runs(sd.find_runs(d, 200)).where("todo")
    kinds = sent.groupBy("h", "c").agg(F.countDistinct("doc_id", "k", "s").alias("runs")).collect()
    assert kinds and all(r["runs"] == 1 for r in kinds)
    assert removed(docs(*rows)) == sorted(brute_removal([t for _, t in rows], 200))
