"""Readers of JSON lines, bronze text, Kafka, CSV and stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusmill.operators.incremental import existing, required

REVIEW = ("id", "text", "timestamp")
DOCUMENT = ("doc_id", "title", "content", "source", "timestamp")


def parse(value: Column, fields: Sequence[str]) -> Column:
    """A JSON object's fields as text; numbers become text, other fields are dropped."""
    return F.from_json(value, ", ".join(f"`{f}` string" for f in fields))


def parse_lines(lines: DataFrame, fields: Sequence[str] = REVIEW) -> DataFrame:
    """Lenient: rows that lack a field, or that aren't JSON, go."""
    return required(lines.select(parse(F.col("value"), fields).alias("r")).select("r.*"), fields)


def parse_lines_keeping(lines: DataFrame, fields: Sequence[str] = DOCUMENT) -> DataFrame:
    """Bad rows become rows of nulls. Works on streams."""
    return lines.select(parse(F.col("value").cast("string"), fields).alias("r")).select("r.*")


def rejects(lines: DataFrame, fields: Sequence[str] = REVIEW) -> DataFrame:
    """One row: how many lines there are, and how many the lenient reader drops."""
    r = parse(F.col("value"), fields)
    missing = r.isNull()
    for f in fields:
        missing = missing | r[f].isNull()
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.coalesce(missing, F.lit(True))).alias("rejected"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of text files, lines numbered from 1 in each file, however files are split.

    A first pass counts the lines of each piece of a file that a task reads; sums over the pieces before it
    give a piece its first number. Ids that rise within a task number the lines of a piece.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(path).select(
        "value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("id")
    )
    counts = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("first")).alias("shift"))
    return lines.join(starts, ["file", "block"]).select("file", (F.col("id") + F.col("shift")).alias("line"), "value")


def read_strict(spark: SparkSession, path: str, fields: Sequence[str] = REVIEW) -> DataFrame:
    """JSON lines without blank ones; a bad line or a missing key fails the job, naming the file, the line's number and its text."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    r, keys = parse(F.col("value"), fields), F.json_object_keys("value")
    whole = keys.isNotNull()
    for f in fields:
        whole = whole & F.array_contains(keys, f)
    lacking = F.array_join(F.array_sort(F.array_except(F.array(*map(F.lit, fields)), keys)), ", ")
    what = F.when(keys.isNull(), "not a JSON object").otherwise(F.concat(F.lit("not a JSON object with all keys, it lacks "), lacking))
    where = F.concat(F.lit(" at line "), F.col("line").cast("string"), F.lit(" of "), F.col("file"), F.lit(": "))
    fail = F.raise_error(F.concat(what, where, F.substring("value", 1, 200)))
    checked = F.when(F.coalesce(whole, F.lit(False)), r).otherwise(fail.cast(f"struct<{','.join(f'`{f}`:string' for f in fields)}>"))
    return lines.select(checked.alias("r")).select("r.*")


def read_bronze(spark: SparkSession, path: str, fields: Sequence[str] = REVIEW) -> DataFrame:
    return parse_lines(spark.read.text(path), fields)


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """Prompts of a load test: bad lines go; `text` stands in for an empty prompt."""
    return prompts(parse_lines_keeping(spark.read.text(path), ("prompt", "text", "output_len")))


def prompts(df: DataFrame) -> DataFrame:
    return df.withColumn("prompt", F.coalesce(F.nullif("prompt", F.lit("")), F.col("text"), F.lit("")))


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", most: int | None = None) -> DataFrame:
    """Values of a topic as text. `most` bounds the offsets of a trigger (pacing)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting)
    reader = reader if most is None else reader.option("maxOffsetsPerTrigger", most)
    return reader.load().select(F.col("value").cast("string"))


def file_stream(spark: SparkSession, path: str, most_files: int = 1) -> DataFrame:
    """Text files of a folder as a stream; `most_files` a trigger (pacing)."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", most_files).load(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Labels as text with a header; missing values are empty."""
    return spark.read.option("multiLine", True).option("escape", '"').csv(path, header=True).na.fill("")


def read_first(spark: SparkSession, *paths: str) -> DataFrame:
    """The first table that exists. A table that is there and can't be read is an error."""
    for path in paths[:-1]:
        if (found := existing(spark, path)) is not None:
            return found
    return spark.read.parquet(paths[-1])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with partition columns as text, or dates would change their type once a
    partition is called `unknown`. The session's own setting stays as it is."""
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(name, before)
