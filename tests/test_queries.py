"""Every registered query of the library against its DuckDB SQL."""

import glob
import os

import duckdb
import pytest

from corpusmill import oracle, queries


def norm(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    return v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = queries.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(repr([norm(r[c]) for c in cols]) for r in df.collect())
    res = duck.execute(oracle.SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted(repr([norm(r[names.index(c)]) for c in cols]) for r in res.fetchall())
    assert got == want


def test_all_but_the_approximate_query_have_sql():
    assert set(queries.QUERIES) - set(oracle.SQL) == {"minhash_dedup"}


def test_minhash_is_close_to_exact(spark, sf_dir):
    near = {r[0] for r in queries.minhash_dedup(spark, sf_dir).collect()}
    exact = {r[0] for r in queries.near_dup_survivors(spark, sf_dir).collect()}
    assert len(near ^ exact) <= 0.02 * len(exact)
