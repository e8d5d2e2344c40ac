"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where that setting is absent, a local session (as in tests) gets a temporary folder, which
    is set so that later calls find the same one. On a cluster its absence is an error, as
    executors can't see each other's folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def column(name: str) -> Column:
    """A column by its very name, which may have dots or backticks."""
    return F.col(f"`{name.replace('`', '``')}`")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet below the shared folder and read it again.

    Cuts the lineage with files that outlive executors, and lets several readers share
    one computation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stash_buckets(df: DataFrame, name: str, key: str, n: int) -> DataFrame:
    """`stash`, dealt to n buckets by `key`: a join with rows in n partitions by that column does not shuffle these files.

    Only the catalog records buckets, so the files are a table of it until they are read; they outlive it.
    """
    spark = df.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    held = f"spark_catalog.default.`{name}`"
    df.write.format("parquet").bucketBy(n, key).option("path", f"{shared_dir(spark)}/{name}").saveAsTable(held)
    try:
        return spark.read.table(held)
    finally:
        spark.sql(f"DROP TABLE {held}")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; a null row is empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        # Null rows may own bytes in a sliced buffer; rebuild without them.
        return utf8(column.fill_null(""))
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(offsets: np.ndarray, most: int = 1 << 20):
    """Ranges of rows whose bytes add up to about `most`; a longer row is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def block_rows(total: np.ndarray, width: int = 1 << 14):
    """A task's sums as rows (block, sums), without blocks of zeros."""
    for k in range(0, len(total), width):
        part = total[k : k + width]
        if part.any():
            yield pa.record_batch({"block": pa.array([k // width], pa.int32()), "sums": pa.array([part.tobytes()], pa.binary())})


def sum_blocks(rows: DataFrame, n: int, kind=np.int64, width: int = 1 << 14) -> np.ndarray:
    """Adds up the rows of `block_rows` from all tasks: an array of the fixed length n.

    Rows of a block meet in a task that adds them one by one; the driver gets n numbers.
    """

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column("block").to_pylist(), batch.column("sums"), strict=True):
                part = np.frombuffer(data.as_buffer(), kind)
                held[k] = held[k] + part if k in held else part.copy()
        for k, part in held.items():
            yield pa.record_batch({"block": pa.array([k], pa.int32()), "sums": pa.array([part.tobytes()], pa.binary())})

    out = np.zeros(n, kind)
    for k, data in rows.repartition("block").mapInArrow(add, "block int, sums binary").collect():
        out[k * width : k * width + width] += np.frombuffer(data, kind)
    return out


_ROOT = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        inverse = pow(_ROOT, -1, 1 << 64)
        _POWERS[:] = [
            np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)]))
            for x in (_ROOT, inverse)
        ]
    return _POWERS[0], _POWERS[1]


BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser for 64-bit hashes, in place."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def token_runs(raw: np.ndarray, offsets: np.ndarray, classes: np.ndarray):
    """Maximal runs of bytes of one class (0: separator) within a row.

    Returns the 64-bit hash of each run, its start and end, and the row boundaries as
    offsets into the runs. The hash depends on the run's bytes alone.
    """
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = classes[raw]
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < n]] = True
    at = np.flatnonzero(edge)
    ends = np.append(at[1:], n)
    keep = kind[at] != 0
    starts, ends = at[keep], ends[keep]
    power, inverse = powers(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(BYTE[raw] * power[:n], out=total[1:])
    h = mix((total[ends] - total[starts]) * inverse[starts])
    return h, starts, ends, np.searchsorted(starts, offsets)


SPACE = np.ones(256, np.uint8)
SPACE[[9, 10, 11, 12, 13, 32]] = 0
