"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Each source's documents are shuffled by a hash and queued, once for each time the mix may
repeat them. A queued copy's virtual finish time is the tokens its source has queued so
far, this copy included, divided by the source's weight. The copies of all sources are
then ordered by finish time and cut where their tokens reach the total budget, so that
at any time the sources have received tokens in proportion to their weights, and a source
that has run dry leaves its share to the others by weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusmill.llm.common import column, stash, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = "mix-1"
ROWS_PER_BUCKET = 1000
ROWS_PER_RANGE = 200_000  # of two numbers each


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Add the running sum of `value` in the order of the last of `keys`, the bucket, and `order`.

    The other keys tell groups apart; none may be null, since the parts are joined on them.
    A window sums within each bucket; a table with a row for each bucket carries what
    the buckets before it hold, so that no task needs a whole group.
    """
    group, bucket = keys[:-1] or [F.lit(0)], keys[-1]
    before = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    starts = (
        df.groupBy(*keys)
        .agg(F.sum(value).alias("__sum"))
        .select(*keys, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    )
    inner = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    summed = df.withColumn("__inner", F.sum(value).over(inner))
    return summed.join(starts, keys).withColumn(out, F.col("__start") + F.col("__inner")).drop("__start", "__inner")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """One row for each source: its size in tokens, number of documents, weight and target.

    Sources are numbered by code point with null last (UTF-8 byte order is code point
    order). The budget fills all sources at rates equal to their weights; a source is
    full at `repeats` times its size. Ordered by the time at which they are full, the
    first sources end full and the others share the rest by weight. The window without
    a key runs over one row for each source.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    by_name = W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    rank = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    total = total.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), rank.cast("int")).cast("double"))
    total = total.withColumn("__cap", F.col("source_size") * F.lit(float(repeats))).withColumn(
        "__full_at", F.col("__cap") / F.col("weight")
    )
    every = W.partitionBy(F.lit(0))
    by_time = every.orderBy("__full_at", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    total = (
        total.withColumn("__budget", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("__full", F.coalesce(F.sum("__cap").over(by_time), F.lit(0.0)))
        .withColumn("__open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_time), F.lit(0.0)))
    )
    # The level if exactly the sources before this one are full; it can only hold where
    # this source isn't full by then. Further sources counted as full lower it, so the
    # largest is the true one.
    level = F.when(
        F.col("__full_at") * F.col("__open") >= F.col("__budget") - F.col("__full"),
        (F.col("__budget") - F.col("__full")) / F.col("__open"),
    )
    total = total.withColumn("__level", F.max(level).over(every))
    target = F.least(F.col("__cap"), F.coalesce(F.col("weight") * F.col("__level"), F.col("__cap")))
    return total.select("source", "source_size", "rows", "weight", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: str = SEED,
    carry: list[str] | None = None,
) -> DataFrame:
    """Columns of docs (or those in `carry`) in a struct `row`, with `size`, `source_size`, `target` and `copies` (0 .. repeats).

    Nulls: a null text has size 0; null is a source of its own, last in order. Documents
    of size 0 cost nothing and are taken as often as the queue reaches them. Rows that
    agree in doc_id and text are queued one after the other, ties in finish time by size. No
    rows give no rows. Columns of docs can have any names.
    """
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))
    shuffle = F.md5(F.concat_ws("/", F.lit(seed), F.col("doc_id").cast("string"), digest))
    # Words are counted once; the passes below read what is written here.
    rows = stash(docs.select(F.struct(*map(column, carry or docs.columns)).alias("row"), "source", word_count(F.col("text")).alias("size"), shuffle.alias("shuffle")), "mix")
    # One row for each source, written so that a join with it deals a hot source's rows anew.
    targets = stash(source_targets(rows, weights, share, repeats).withColumnRenamed("source", "__source"), "mix-sources")
    placed = rows.join(targets, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    lead = F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("double") / float(1 << 32)
    placed = placed.withColumns(
        {
            "group": F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")),
            "bucket": F.floor(lead * F.ceil(F.col("rows") / ROWS_PER_BUCKET)),
        }
    )
    queued = running(placed, ["group", "bucket"], ["shuffle", "size"], "size", "queued")
    times = [(F.lit(i) * F.col("source_size") + F.col("queued")) / F.col("weight") for i in range(repeats)]
    queued = queued.withColumn("times", F.array(*times))

    # Range sort of all copies by finish time: Spark cuts the ranges at quantiles, and a window
    # sorts within each. `cut` is the last finish time at which the budget isn't exceeded.
    total = targets.agg(F.sum("source_size").alias("size"), F.sum("rows").alias("rows")).first()
    finish = queued.select("size", F.explode("times").alias("finish"))
    # Documents without words cost nothing and may be many at one time: one stands for all.
    finish = finish.where("size > 0").unionByName(finish.where("size = 0").distinct())
    ranges = max(1, -(-(total["rows"] or 0) * repeats // ROWS_PER_RANGE))
    sorted_ = stash(finish.repartitionByRange(ranges, "finish", "size").withColumn("range", F.spark_partition_id()), "mix-finish")
    spent = running(sorted_, ["range"], ["finish", "size"], "size", "spent")
    cut = spent.where(F.col("spent") <= F.lit((total["size"] or 0) * share)).agg(F.max("finish")).first()[0]
    taken = F.size(F.filter("times", lambda t: t <= F.lit(cut))) if cut is not None else F.lit(repeats)
    return queued.select("row", "size", "source_size", "target", taken.cast("int").alias("copies"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it, with the columns of docs."""
    taken = mix(docs).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws('/', 'mix-1', doc_id::VARCHAR, md5(coalesce(text, '')))) AS spot
  FROM documents),
q AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY spot, size ROWS UNBOUNDED PRECEDING) AS queued FROM d),
s AS (SELECT source, sum(size)::DOUBLE AS source_size, 2 * sum(size)::DOUBLE AS cap,
             [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
      FROM d GROUP BY source),
b AS (SELECT 1.5 * sum(source_size) AS budget FROM s),
levels AS (
  SELECT a.cap / a.weight AS full_at,
         (any_value(budget) - sum(CASE WHEN o.cap / o.weight < a.cap / a.weight THEN o.cap ELSE 0 END))
         / sum(CASE WHEN o.cap / o.weight < a.cap / a.weight THEN 0 ELSE o.weight END) AS level
  FROM s a, s o, b GROUP BY a.source, a.cap, a.weight),
l AS (SELECT max(level) AS level FROM levels WHERE full_at >= level),
t AS (SELECT source, source_size, weight, least(cap, weight * coalesce((SELECT level FROM l), cap / weight)) AS target FROM s),
j AS (SELECT q.doc_id, q.size, t.source_size, t.target, q.queued / t.weight AS f0, (t.source_size + q.queued) / t.weight AS f1
      FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source),
f AS (SELECT size, f0 AS finish FROM j UNION ALL SELECT size, f1 FROM j),
r AS (SELECT finish, sum(size) OVER (ORDER BY finish, size ROWS UNBOUNDED PRECEDING) AS spent FROM f),
c AS (SELECT max(finish) AS cut FROM r, b WHERE spent <= budget)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * ((f0 <= cut)::INT + (f1 <= cut)::INT))::BIGINT AS taken
FROM j, c
"""
