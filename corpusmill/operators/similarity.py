"""Exact cosine top-k of a set of queries against all vectors, by blocked matrix products.

Vectors are dealt into tiles of bounded size, and queries as well. Each pair of a tile of queries and a
tile of vectors is one group, which multiplies matrices and keeps the k best of each query; rows of
the vectors are sent once for each tile of queries. The tiles' lists are then merged, some tiles at a time.

Vectors of one tile lie in the same corner of space where possible: the signs of their first components
deal them. Within a tile, a vector is the mean of its block and a rest, so that no vector of a
block is more similar to a query than the mean and the longest rest say. Blocks are taken in the order of
this bound, and left out for queries that have k better ones already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 50_000  # vectors of a tile, about
QUERIES = 10_000  # queries of a tile, about
BLOCK = 1024
SIGNS = 8
PLACES = 9  # decimals of a similarity; what agrees in these is a tie, which the lesser id wins
MERGED = 32  # lists of a query that are merged at once


def unit(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows of length one as doubles; vectors of length zero stay zero. All must have the same number of components."""
    flat = np.concatenate([np.zeros(0)] + [c.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for c in vectors.chunks])
    rows = flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 1)
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def best(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(similarities, ids) of the k best vectors for each query, ties by id; -inf and 0 where there are fewer than k."""
    n = len(queries)
    have, names = np.full((n, k), -np.inf), np.zeros((n, k), np.int64)
    order = np.argsort((vectors[:, :SIGNS] > 0) @ (1 << np.arange(min(SIGNS, vectors.shape[1])))) if len(vectors) else np.zeros(0, np.int64)
    blocks = [order[i : i + block] for i in range(0, len(order), block)]
    means = np.array([vectors[b].mean(axis=0) for b in blocks]).reshape(len(blocks), -1)
    rests = np.array([np.linalg.norm(vectors[b] - m, axis=1).max() for b, m in zip(blocks, means, strict=True)])
    bounds = queries @ means.T + rests if blocks else np.zeros((n, 0))
    for j in np.argsort(-bounds.mean(axis=0)) if n else ():
        # A block whose bound only equals the k-th best may hold a tie with a lesser id.
        rows = np.flatnonzero(bounds[:, j] + 10.0**-PLACES >= have[:, -1])
        if len(rows) == 0:
            continue
        found = np.round(queries[rows] @ vectors[blocks[j]].T, PLACES) + 0.0
        score = np.concatenate([have[rows], found], axis=1)
        name = np.concatenate([names[rows], np.broadcast_to(ids[blocks[j]], found.shape)], axis=1)
        top = np.lexsort((name, -score), axis=1)[:, :k]
        have[rows], names[rows] = np.take_along_axis(score, top, 1), np.take_along_axis(name, top, 1)
    return have, names


def cosine_topk(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int = 10, tile: int = TILE, query_tile: int = QUERIES) -> DataFrame:
    """query, rank (from 1), key, similarity of the k vectors most similar to each query.

    Both frames have an integer key and an array of numbers, all of one length. Similarities are
    rounded to nine decimals; of equal ones the lesser key comes first. A vector of length zero has similarity 0 to all; rows
    without a vector go. A query is compared with all vectors, also with its own row.
    """
    whole = lambda df: df.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    queries, vectors = whole(queries), whole(vectors)
    deal = lambda n, size: -(-max(n, 1) // size)
    n_q, n_v = deal(queries.count(), query_tile), deal(vectors.count(), tile)
    # Corners of space, and a hash where a corner holds more than a tile's share of the vectors.
    corner = sum((F.when(F.get("v", F.lit(i)) > 0, F.lit(1 << i)).otherwise(F.lit(0)) for i in range(SIGNS)), F.lit(0))
    spread = F.pmod(F.xxhash64("id"), F.lit(n_v))
    vectors = vectors.withColumn("corner", corner)
    crowded = vectors.groupBy("corner").agg(F.count(F.lit(1)).alias("n")).select("corner", (F.col("n") > tile).alias("crowded"))
    v_tile = F.when(F.col("crowded"), spread).otherwise(F.pmod(F.hash("corner"), F.lit(n_v))).cast("int")
    vectors = vectors.join(crowded, "corner").select("id", "v", v_tile.alias("v_tile"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(n_q)).cast("int").alias("q_tile"), every(n_v).alias("v_tile"))
    right = vectors.select("id", "v", "v_tile", every(n_q).alias("q_tile"))

    def multiply(key: tuple, q: pa.Table, v: pa.Table) -> pa.Table:
        if len(q) and len(v):
            score, name = best(unit(q["v"]), unit(v["v"]), v["id"].to_numpy(), k)
        else:
            score, name = np.full((len(q), k), -np.inf), np.zeros((len(q), k), np.int64)
        at = np.flatnonzero(np.isfinite(score.ravel()))
        ids = np.repeat(q["id"].to_numpy(), k)[at]
        cols = [pa.array(ids), pa.array(np.full(len(at), key[1].as_py(), np.int32)), pa.array(score.ravel()[at]), pa.array(name.ravel()[at])]
        return pa.Table.from_arrays(cols, ["query", "part", "similarity", "id"])

    found = left.groupBy("q_tile", "v_tile").cogroup(right.groupBy("q_tile", "v_tile")).applyInArrow(
        multiply, "query long, part int, similarity double, id long"
    )
    lists = found.groupBy("query", "part").agg(_top(k))
    while n_v > 1:
        n_v = deal(n_v, MERGED)
        lists = lists.select("query", F.floor(F.col("part") / MERGED).cast("int").alias("part"), F.explode("top").alias("x")).select("query", "part", "x.*")
        lists = lists.groupBy("query", "part").agg(_top(k))
    ranked = lists.select("query", F.posexplode("top").alias("rank", "x"))
    return ranked.select("query", (F.col("rank") + 1).alias("rank"), F.col("x.id").alias(key), F.col("x.similarity").alias("similarity"))


def _top(k: int):
    """The k best of the rows of a group, which has at most MERGED * k of them."""
    rows = F.collect_list(F.struct((-F.col("similarity")).alias("down"), F.col("id").alias("id"), F.col("similarity").alias("similarity")))
    return F.transform(F.slice(F.sort_array(rows), 1, k), lambda x: F.struct(x["similarity"].alias("similarity"), x["id"].alias("id"))).alias("top")
