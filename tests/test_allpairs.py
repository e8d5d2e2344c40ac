import random

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF, MinHashLSH
from pyspark.sql import functions as F

from corpusmill.operators import allpairs, dedup


def sentences(seed, n, words=400):
    """n texts of one language: no two are alike, and any two share most of their rarer trigrams."""
    draw = random.Random(seed)
    known = ["".join(draw.choices("etaoinshrdlucmfw", k=draw.randint(2, 9))) for _ in range(3000)]
    weights = [1 / (k + 1) for k in range(len(known))]
    return [" ".join(draw.choices(known, weights, k=words)) for _ in range(n)]


def moved(spark, run):
    """Bytes that run() shuffles."""
    context = spark.sparkContext._jsc.sc()
    total = lambda: context.listenerBus().waitUntilEmpty() or context.statusStore().executorList(True).apply(0).totalShuffleWrite()
    before = total()
    run()
    return total() - before


def brute(texts, n=3, num=4, den=5):
    """(a, b, shared, together) of {id: text} by Python's sets."""
    sets = {i: {t.lower()[k : k + n] for k in range(len(t) - n + 1)} for i, t in texts.items()}
    pairs = [(a, b, len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a in texts for b in texts if a < b]
    return sorted(x for x in pairs if x[2] * den > x[3] * num)


def frame(spark, texts, kind="long"):
    return spark.createDataFrame(list(texts.items()), f"id {kind}, text string")


@pytest.mark.parametrize("query", ["minhash_survivors", "near_pairs", "near_survivors"])
def test_texts_of_a_language_are_compared_without_rows_for_candidates(spark, query):
    """candidates were written, several times the bytes of the texts."""
    texts = dict(enumerate(sentences(1, 500)))
    texts[500] = texts[3] + " and so"
    df = frame(spark, texts).repartition(4).cache()
    df.count()
    found = []
    bytes_moved = moved(spark, lambda: found.extend(tuple(r)[0] for r in getattr(dedup, query)(df, "id", "text").drop("text").collect()))
    assert sorted(found) == ([3] if query == "near_pairs" else list(range(500)))
    assert bytes_moved < 2.5 * sum(map(len, texts.values()))


def test_minhash_leaves_what_spark_leaves(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 2 = 0").select(F.col("doc_id").alias("id"), "text")
    texts = dict(enumerate(sentences(2, 20, 60), 10_000))
    for i in range(20):
        texts[20_000 + i] = texts[10_000 + i] + " " + " ".join(sentences(i, 1, 3 + i % 6))
    docs = docs.unionByName(frame(spark, texts))
    unique = dedup.once(docs, "id", "text", 3)
    tokens = unique.select("id", dedup.grams(F.col("text")).alias("grams")).where(F.size("grams") > 0)
    features = HashingTF(inputCol="grams", outputCol="features", numFeatures=1 << 18, binary=True).transform(tokens).select("id", "features").cache()
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=2, seed=17).fit(features)
    near = model.approxSimilarityJoin(features, features, 1.0 - 0.8).where("datasetA.id < datasetB.id")
    gone = {r[0] for r in near.select("datasetB.id").distinct().collect()}
    want = {r["id"] for r in unique.collect()} - gone
    assert gone and {r["id"] for r in dedup.minhash_survivors(docs, "id", "text", tables=2).collect()} == want


def test_terms_have_the_places_of_hashing_tf():
    table = HashingTF(numFeatures=1 << 18)
    for term in ("a", "ab", "abc", "abcd", "äö!", "Straße", "字字字", "x😀y", " \t\n"):
        assert dedup.bucket(term, 1 << 18) == table.indexOf(term)


@pytest.mark.parametrize("n", [3, 5])
def test_grams_beyond_the_common_ones_count(spark, n):
    """Far more different grams than have bits."""
    draw = np.random.default_rng(5)
    texts = {}
    for i in range(60):
        base = "".join(chr(c) for c in draw.integers(0x4E00, 0x9000, 400))
        texts |= {3 * i: base, 3 * i + 1: base[: 399 - i % 45], 3 * i + 2: base[i + 1 :] + base[: i + 1]}
    assert len({t[k : k + n] for t in texts.values() for k in range(len(t) - n + 1)}) > 2 * allpairs.COMMON
    want = brute(texts, n)
    got = dedup.near_pairs(frame(spark, texts), "id", "text", n).collect()
    assert len(want) > 100 and sorted((r["id_a"], r["id_b"], r["jaccard"]) for r in got) == [(a, b, s / t) for a, b, s, t in want]
    kept = sorted(r["id"] for r in dedup.near_survivors(frame(spark, texts), "id", "text", n).collect())
    assert kept == sorted(set(texts) - {b for _, b, _, _ in want})


@pytest.mark.parametrize("kind", ["long", "string"])
def test_blocks_of_several_languages_and_sizes(spark, monkeypatch, kind):
    """Small blocks, so that most pairs lie in two of them, or are ruled out."""
    monkeypatch.setattr(allpairs, "BLOCK", 7)
    texts, draw = {}, random.Random(4)
    for k, words in enumerate((3, 20, 60, 200)):
        for t in sentences(k, 12, words) + [t.upper()[::-1].translate(str.maketrans("ETAOIN", "ÄÖÜßÇÉ")) for t in sentences(k, 12, words)]:
            for cut in (0, 1, len(t) // 15, len(t) // 6):
                texts[len(texts)] = t[cut:] + "".join(draw.choices("xyz", k=cut // 3))
    ids = list(texts)
    random.Random(9).shuffle(ids)
    texts = dict(zip(ids if kind == "long" else map(str, ids), texts.values(), strict=True))
    first = {}
    for i in sorted(texts):
        first.setdefault(texts[i].lower(), i)
    want = brute({i: texts[i] for i in first.values()})
    got = dedup.near_pairs(frame(spark, texts, kind), "id", "text").collect()
    assert len(want) > 100 and sorted((r["id_a"], r["id_b"], r["jaccard"]) for r in got) == [(a, b, s / t) for a, b, s, t in want]
    kept = sorted(r["id"] for r in dedup.near_survivors(frame(spark, texts, kind), "id", "text").collect())
    assert kept == sorted(set(first.values()) - {b for _, b, _, _ in want})


def test_null_keys_and_odd_texts(spark):
    df = spark.createDataFrame([(None, "abcdefgh"), (1, "abcdefgH"), (2, "ab"), (3, None), (4, ""), (5, "xyz xyz xyz"), (6, "xyz xyz xyzz xyz")], "id long, text string")
    assert sorted(r["id"] or 0 for r in dedup.near_survivors(df, "id", "text").collect()) == [0, 2, 3, 4, 5, 6]
    assert dedup.near_pairs(df, "id", "text").collect() == []
    assert dedup.near_pairs(df.limit(0), "id", "text").collect() == [] and dedup.minhash_survivors(df.limit(0), "id", "text").collect() == []
