"""Incremental windows, latest rows, samples and idempotent appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which all the columns have values."""
    return df.na.drop(how="any", subset=list(columns))


def nonblank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text has more than spaces (U+0020 only: a tab counts as content)."""
    return df.where(F.length(F.trim(column)) > 0)


def watermark(df: DataFrame, column: Column) -> DataFrame:
    return df.agg(F.max(column).alias("watermark"))


def since(df: DataFrame, column: str, target: DataFrame | None, target_column: Column | None = None, date: str | None = None) -> DataFrame:
    """Rows later than the latest of the target (parity: late rows are dropped for good).

    The watermark comes to the driver as a literal, so that the filter is pushed into the
    scan; `date` names a partition column holding the day, which prunes partitions.
    """
    mark = None
    if target is not None:
        mark = watermark(target, F.col(column) if target_column is None else target_column).first()[0]
    if mark is None:
        return df
    df = df.where(F.col(column) > F.lit(mark))
    return df if date is None else df.where(F.col(date) >= F.lit(str(mark)[:10]))


def unseen(df: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys the target lacks. A null key equals nothing, so such rows are unseen."""
    return df if target is None else df.join(target.select(*keys).distinct(), list(keys), "left_anti")


def has_new(df: DataFrame) -> bool:
    return not df.isEmpty()


def latest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order, which should be total."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def seeded_sample(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """k rows in the order of a hash of key and seed; all rows if there are fewer."""
    spot = F.md5(F.concat_ws("::", F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("__spot", spot).orderBy("__spot", key).limit(k).drop("__spot")


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None before the first write.

    Only a missing path counts as that; any other failure to read is raised, since it
    would otherwise switch off the search for duplicates.
    """
    try:
        return spark.read.option("mergeSchema", "false").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_plan(df: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """What an idempotent append writes: one row for each key that the target lacks.

    Of rows with equal keys that with the least other columns (maps aside) stays.
    """
    order = [F.col(c).asc_nulls_last() for c, kind in df.dtypes if c not in keys and "map<" not in kind]
    whole = required(df, keys)
    loose = df.where(" OR ".join(f"`{k}` IS NULL" for k in keys)).dropDuplicates(list(keys))
    return unseen(latest(whole, keys, *(order or [F.lit(0)])), target, keys).unionByName(loose)


def append_idempotent(
    df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), compression: str = "snappy"
) -> int:
    """Append the rows whose keys are new. Returns their number; nothing is written for 0."""
    new = append_plan(df, existing(df.sparkSession, path), keys)
    if new.isEmpty():
        return 0
    seen = Observation()
    written = new.observe(seen, F.count(F.lit(1)).alias("n"))
    written.write.mode("append").option("compression", compression).partitionBy(*partition_by).parquet(path)
    return seen.get["n"]
