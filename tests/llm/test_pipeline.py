import zlib
from collections import Counter

import duckdb
import pytest
from test_duplicates import brute_classes
from pyspark.sql import functions as F
from test_scans import brute

import corpus_pipeline
from corpusmill.llm import queries
from corpusmill.llm.common import stash, table


def test_stages_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    kept = {}
    df = docs
    for name, stage in corpus_pipeline.STAGES:
        df = stash(stage(spark, df, sf_dir), name)
        kept[name] = df.collect()
        if name != "sharding":
            assert df.columns == docs.columns
    good = sorted(kept["quality"], key=lambda r: r["doc_id"])
    assert 0 < len(good) < docs.count()
    ids = [r["doc_id"] for r in good]
    classes = brute_classes([r["text"] for r in good])
    one = sorted({ids[c] for _, c, _, _ in classes})
    assert sorted(r["doc_id"] for r in kept["near_duplicates"]) == one
    clean = []
    for r in kept["near_duplicates"]:
        n, hit, _ = brute(r["text"], items)
        if not (hit > 0 and 20 * hit >= n):
            clean.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in kept["decontamination"]) == sorted(clean)
    copies = Counter(r["doc_id"] for r in kept["mixing"])
    assert set(copies) <= set(clean) and max(copies.values()) <= 2
    assert len(kept["sharding"]) == len(kept["mixing"])
    text = {r["doc_id"]: r["text"] for r in good}
    for r in kept["sharding"]:
        assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) and 0 <= r["shard"] <= 7


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf_dir)
    res = con.execute(queries.SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    norm = lambda v: f"{v:.9g}" if isinstance(v, float) else v
    want = sorted(repr([norm(v) for v in r]) for r in res.fetchall())
    assert sorted(repr([norm(r[c]) for c in names]) for r in df.collect()) == want


def test_names():
    assert [x.split("_")[0] for x in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.SQL) < set(queries.QUERIES)


def test_stages_on_odd_rows(spark, docs, tmp_path):
    """Nulls in every column, empty texts, repeated rows and columns with names used inside; then no rows at all."""
    good = " ".join(f"river stone {i} lamp cloud" for i in range(30))
    rows = [(i, f"{good} {i}") for i in range(12)] + [(40, good), (40, good), (None, None), (None, ""), (50, "x"), (51, "x" * 100_000)]
    names = ("score", "predicted", "row", "items", "spans", "n_words", "size", "target", "copies", "k", "id", "root", "shard", "a.b", "a`b", "__k", "__doc", "__none", "__bucket")
    d = docs(*rows).select("*", *(F.lit(n).alias(n) for n in names)).withColumn("lang", F.lit(None).cast("string"))
    d = d.withColumn("source", F.when(F.col("doc_id") > 3, F.col("source"))).withColumn("n_chars", F.lit(None).cast("long"))
    labels = spark.createDataFrame([(i, int(i < 12), 0) for i in (*range(12), 40, 50, 51)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, None), (1, ""), (2, good[:200])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (d, d.limit(0)):
        df = start
        for name, stage in corpus_pipeline.STAGES:
            before = df
            df = stash(stage(spark, df, str(tmp_path)), name)
            if name != "sharding":
                assert df.columns == d.columns and all(r[n] == n for r in df.collect() for n in names)
            assert df.count() <= 2 * before.count()


def test_stages_one_by_one_on_odd_rows(spark, docs, tmp_path):
    """Each stage alone, so that none is spared by what the one before rejects."""
    rows = [(1, "a b c"), (1, "a b c"), (None, None), (None, ""), (2, " "), (3, "z " * 60_000)]
    d = docs(*rows)
    spark.createDataFrame([(1, "b c d")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {name: stage(spark, d, str(tmp_path)).collect() for name, stage in corpus_pipeline.STAGES}
    assert len(kept["quality"]) <= 6 and len(kept["sharding"]) == 6
    assert sorted(str(r["doc_id"]) for r in kept["near_duplicates"]) == ["1", "2", "3", "None"]
    assert len(kept["decontamination"]) == 6
    words = sum(len((r["text"] or "").split()) for r in kept["mixing"])
    assert words <= 2 * 60_006
