"""Exact order statistics of groups by histograms of value ranges.

Each rank has a range of values that holds it, at first that of the whole group. A pass cuts the range
into equal bins and counts the values of each; the bin with the rank becomes the new range, from its least to its
greatest value. Every pass with different values left is narrower, and the range ends as one value. Counts are added up
before they are shuffled, so a group is never in one place, however large it is and however often
a value occurs; a histogram has BINS rows at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.sources.sinks import written

BINS = 2048


def ranked_values(df: DataFrame, group: str, value: str, ranks: DataFrame, bins: int = BINS) -> DataFrame:
    """(group, target, value): the value at each rank of `ranks` (group, target, rank; from 0, in ascending order).

    Nulls in `value` are not ranked, and -0.0 is 0.0. NaN is greater than all others, as in Spark's order. A null group is a
    group. Ranks of groups without that many values are left out.
    """
    values = df.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), (F.col(value).cast("double") + 0.0).alias("v"))
    spans = values.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"))
    ranks = ranks.select(F.col(group).alias("of"), "target", F.col("rank").cast("long").alias("rank"))
    opened = ranks.join(spans, F.col("of").eqNullSafe(F.col("g"))).where("rank >= 0 AND rank < n").select("g", "target", "rank", "lo", "hi")
    done = None
    while True:
        opened = written(opened)
        same = F.col("lo") == F.col("hi")
        found = opened.where(same).select("g", "target", F.col("lo").alias("value"))
        done = found if done is None else done.unionByName(found)
        opened = opened.where(~same)
        if opened.isEmpty():
            return done.withColumnRenamed("g", group)
        opened = _narrowed(values, opened, bins)


def _narrowed(values: DataFrame, opened: DataFrame, bins: int) -> DataFrame:
    """The bin of each range that holds its rank, as the next range."""
    # Ranks that share a range share its histogram.
    ranges = opened.groupBy("g", "lo", "hi").agg(F.collect_set(F.struct("rank", "target")).alias("ranks"))
    ranges = written(ranges.select(F.col("g").alias("of"), "lo", "hi", "ranks"))
    inside = values.join(ranges.drop("ranks"), F.col("g").eqNullSafe(F.col("of")) & F.col("v").between(F.col("lo"), F.col("hi")))
    counts = inside.groupBy("g", "lo", "hi", bin_of(F.col("v"), F.col("lo"), F.col("hi"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most")
    )
    histograms = counts.groupBy("g", "lo", "hi").agg(F.sort_array(F.collect_list(F.struct("bin", "c", "least", "most"))).alias("bins"))
    ranges = ranges.withColumnsRenamed({"lo": "from", "hi": "upto"})
    same = F.col("g").eqNullSafe(F.col("of")) & (F.col("lo") == F.col("from")) & (F.col("hi") == F.col("upto"))
    each = histograms.join(ranges, same).select("g", "bins", F.explode("ranks").alias("r"))
    start = F.struct(F.col("r.rank").alias("left"), F.lit(None).cast("struct<bin:int,c:bigint,least:double,most:double>").alias("hit"))
    step = lambda acc, b: F.when(acc["hit"].isNotNull(), acc).when(acc["left"] < b["c"], F.struct(acc["left"].alias("left"), b.alias("hit"))).otherwise(F.struct((acc["left"] - b["c"]).alias("left"), acc["hit"].alias("hit")))
    return each.withColumn("at", F.aggregate("bins", start, step)).select(
        "g", F.col("r.target").alias("target"), F.col("at.left").alias("rank"), F.col("at.hit.least").alias("lo"), F.col("at.hit.most").alias("hi")
    )


def bin_of(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """The bin of a value between lo and hi; both ends are in different bins, and infinities and NaN have one each."""
    infinite = lambda x: F.abs(x) == F.lit(float("inf"))
    odd = F.isnan(hi) | infinite(hi) | infinite(lo)
    # Halves, since the difference of two doubles may be too large for one.
    share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    even = F.least(F.floor(share * (bins - 1)).cast("int"), F.lit(bins - 1))
    # With an infinite end, bins follow the binary logarithm on both sides of zero.
    size = F.floor(F.log2(F.abs(v))).cast("int") + 1100
    scale = F.when(F.isnan(v), 5000).when(infinite(v), F.signum(v).cast("int") * 4000).when(v == 0, 0).otherwise(F.signum(v).cast("int") * size)
    # A range too narrow for halves (its bins would be none) is cut at its least value.
    return F.when(odd, scale).otherwise(F.coalesce(F.when(hi / 2 == lo / 2, (v > lo).cast("int")), even))
