import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.operators import evaluation, selection, similarity


def test_ranks_of_all_kinds_of_values(spark):
    rng = random.Random(2)
    kinds = {
        "whole": [float(rng.randint(-5, 5)) for _ in range(60)],
        "tiny": [5e-324 * rng.randint(0, 9) for _ in range(40)],
        "wide": [rng.choice([-1, 1]) * 2.0 ** rng.randint(-1070, 1023) for _ in range(40)],
        "huge": [-1.7e308, 1.7e308, 1.0, 2.0],
        "odd": [math.inf, -math.inf, math.nan, 0.0, -0.0, 1.0, -3.0, math.nan, 2.0**60, 1e-300],
        "one": [7.0],
        None: [3.0, 1.0, 2.0, 1.0],
    }
    df = spark.createDataFrame([(g, v) for g, vs in kinds.items() for v in [*vs, None]], "g string, v double")
    ranks = spark.createDataFrame([(g, str(i), i) for g, vs in kinds.items() for i in range(-1, len(vs) + 1)], "g string, target string, rank int")
    want = {(g, str(i)): v for g, vs in kinds.items() for i, v in enumerate(sorted(vs, key=lambda v: (math.isnan(v), v)))}
    got = {(r["g"], r["target"]): r["value"] for r in selection.ranked_values(df, "g", "v", ranks, 64).collect()}
    assert {k: repr(v + 0.0) for k, v in got.items()} == {k: repr(v + 0.0) for k, v in want.items()}


def test_a_group_of_a_million_values(spark):
    df = spark.range(1_000_000).select(F.lit("a").alias("g"), ((F.col("id") * 7919) % 1_000_003 / 1000).alias("v"), F.lit(None).cast("string").alias("e"))
    df = df.unionByName(spark.createDataFrame([("b", 1.0, None), (None, None, "OOM"), (None, 2.0, "timeout")], "g string, v double, e string"))
    summary = evaluation.latency_summary(df, "v", "e", 2.0, "g")
    got = {r["g"]: (r["n"], r["p50"], r["p99"], r["oom_count"], r["timeout_count"]) for r in summary.collect()}
    values = np.sort(np.arange(1_000_000) * 7919 % 1_000_003 / 1000)
    assert got["a"] == (1_000_000, (values[499_999] + values[500_000]) / 2, values[989_999], 0, 0)
    assert got["b"] == (1, 1.0, None, 0, 0) and got[None] == (1, 2.0, None, 1, 1)
    plan = summary._jdf.queryExecution().executedPlan().toString().lower()
    assert "percentile" not in plan and "window" not in plan


def brute(queries, vectors, k):
    out = []
    for i, q in queries:
        score = []
        for j, v in vectors:
            n = math.sqrt(sum(x * x for x in q)) * math.sqrt(sum(x * x for x in v))
            score.append((-(round(sum(x * y for x, y in zip(q, v, strict=True)) / n, 9) if n else 0.0), j))
        out += [(i, r, j, -s + 0.0) for r, (s, j) in enumerate(sorted(score)[:k], 1)]
    return sorted(out)


def topk(queries, vectors, **options):
    return sorted((r["query"], r["rank"], r["id"], r["similarity"]) for r in similarity.cosine_topk(queries, vectors, "id", "v", **options).collect())


@pytest.mark.parametrize("tile", [7, 50_000])
def test_topk_equals_brute_force(spark, tile):
    rng = np.random.default_rng(4)
    made = [(int(i), [float(x) for x in rng.integers(-2, 3, 12)]) for i in range(-20, 150)]
    made += [(200, [0.0] * 12), (201, made[0][1]), (202, [2 * x for x in made[0][1]])]
    df = spark.createDataFrame([*made, (300, None)], "id long, v array<double>")
    queries = df.where("id % 10 = 0")
    want = brute([m for m in made if m[0] % 10 == 0], made, 6)
    got = topk(queries, df, k=6, tile=tile, query_tile=5)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 2e-9 for g, w in zip(got, want, strict=True))


def test_topk_with_few_vectors_or_none(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0])], "id long, v array<double>")
    assert [r[:3] for r in topk(df.where("id = 1"), df, k=5)] == [(1, 1, 1), (1, 2, 2)]
    assert topk(df.limit(0), df) == [] and topk(df, df.limit(0)) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(1, 9), st.integers(1, 40))
def test_blocks_left_out_hold_nothing_better(seed, k, block):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 10))
    vectors = centres[rng.integers(0, 5, 200)] + rng.normal(size=(200, 10)) * rng.choice([0, 0.02, 1])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    have, names = similarity.best(vectors[:20], vectors, np.arange(200), k, block)
    score = np.round(vectors[:20] @ vectors.T, similarity.PLACES)
    want = np.lexsort((np.broadcast_to(np.arange(200), score.shape), -score), axis=1)[:, :k]
    np.testing.assert_allclose(have, np.take_along_axis(score, want, 1), atol=2e-9)
