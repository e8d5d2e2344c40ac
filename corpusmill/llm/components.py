"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusmill.llm.common import stash

SALTS = 4


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node hands its least neighbour to its larger (large star) or smaller neighbours.

    A node's neighbours are dealt by salts, and its least neighbour goes to each, so that no task
    gets a whole hub and Spark can split what is still large.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    every = low.withColumn("salt", F.explode(F.array(*(F.lit(i).cast("long") for i in range(SALTS)))))
    met = both.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS))).join(every, ["u", "salt"])
    if large:
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, stored, and their number with two checksums, taken while they are written."""
    seen = Observation()
    edges = edges.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("a", "b")).alias("x"),
        F.bit_xor(F.xxhash64("b", "a")).alias("y"),
    )
    edges = stash(edges, "edges")
    return edges, tuple(seen.get[k] for k in ("n", "x", "y"))


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the component's least node.

    Edges are longs without nulls, in either direction; loops count for nothing, so a node
    that has only loops is left out. The steps are repeated until nothing changes.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, before = _written(edges.distinct())
    for _ in range(most):
        if not before[0]:
            break
        edges, now = _written(_star(_star(edges, large=True), large=False))
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
