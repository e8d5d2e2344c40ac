"""Structured Streaming: bronze ingestion, parsed documents, deduplication and supervision."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from corpusmill.sources.sinks import written


def bronze(lines: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds") -> StreamingQuery:
    """Append lines as text. every=None takes what is there and ends."""
    writer = lines.select("value").writeStream.format("text").outputMode("append").option("path", path)
    return _start(writer.option("checkpointLocation", checkpoint), every)


def parquet(rows: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer.option("checkpointLocation", checkpoint), every)


def each_batch(rows: DataFrame, write: Callable[[DataFrame], object], checkpoint: str, every: str | None = "10 seconds") -> StreamingQuery:
    """Hand every micro-batch to an idempotent writer; replayed batches add nothing."""
    writer = rows.writeStream.foreachBatch(lambda df, _: write(df)).option("checkpointLocation", checkpoint)
    return _start(writer, every)


def _start(writer, every: str | None) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def _timed(rows: DataFrame, time_column: str, delay: str) -> DataFrame:
    return rows.withColumn(time_column, F.col(time_column).cast("timestamp")).withWatermark(time_column, delay)


def distinct_within(rows: DataFrame, keys: list[str], time_column: str, delay: str) -> DataFrame:
    """The first row of each key, with state kept for `delay` of event time (an extension)."""
    return _timed(rows, time_column, delay).dropDuplicatesWithinWatermark(keys)


#: Keyed state needs the state store that can hold more than one value of a key.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class _Latest(StatefulProcessor):
    """Keeps the latest row of a key until the watermark has passed it by `keep` seconds."""

    def __init__(self, names: list[str], schema: str, time_column: str, keep: float, late: str):
        self.names, self.schema, self.time, self.keep, self.late = names, schema, time_column, keep, late

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("row", self.schema)

    def _rows(self, rows: list[tuple], late: bool) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=self.names)
        return frame.assign(**{self.late: pd.Series([late] * len(frame), dtype="bool")})

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentWatermarkInMs()
        at = self.names.index(self.time)
        stamp = lambda row: pd.Timestamp(row[at]).value // 1_000_000
        best, late = self.held.get(), []
        had = best is not None
        for frame in rows:
            for row in frame[self.names].itertuples(index=False, name=None):
                if stamp(row) < mark:
                    late.append(row)
                elif best is None or (row[at], repr(row)) > (pd.Timestamp(best[at]), repr(tuple(best))):
                    best = row
        if best is not None:
            self.held.update(tuple(best))
            if had:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(max(stamp(best), mark) + 1000 * self.keep))
        if late:
            yield self._rows(late, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        row = self.held.get()
        if row is not None:
            self.held.clear()
            yield self._rows([tuple(row)], False)

    def close(self) -> None:
        pass


def latest_and_late(rows: DataFrame, keys: list[str], time_column: str, delay: str, keep: float = 0.0, late: str = "late") -> DataFrame:
    """The latest row of each key once event time is past it, and all rows that came too late, marked in `late`.

    A row is late if its time is below the watermark, which is `delay` behind the greatest time seen; a key's latest
    row is given out when the watermark is `keep` seconds past it, and of rows with equal times one is
    taken. Late rows change nothing that has been given out. `split_late` stores both kinds apart. The session needs
    STATE_STORE, and state is kept for keys only whose latest row is not yet out.
    """
    # Spark itself drops late rows where it sees the column with the watermark: a copy of it is not that column.
    timed = _timed(rows, time_column, delay).withColumn(time_column, F.col(time_column) + F.expr("INTERVAL 0 SECONDS"))
    schema = ", ".join(f"`{n}` {t}" for n, t in timed.dtypes)
    return timed.groupBy(*keys).transformWithStateInPandas(
        _Latest(timed.columns, schema, time_column, keep, late), f"{schema}, `{late}` boolean", "Append", "EventTime"
    )


def split_late(path: str, late_path: str, late: str = "late") -> Callable[[DataFrame, int], None]:
    """A writer of micro-batches: rows on time to one table, late ones to another.

    Each batch is a folder of its own that a replay overwrites, so that a restart stores no row twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = written(batch)
        for part, where in ((rows.where(~F.col(late)), path), (rows.where(late), late_path)):
            part.drop(late).write.mode("overwrite").parquet(f"{where}/batch={number}")

    return write


def tumbling_counts(rows: DataFrame, time_column: str, width: str, delay: str, *keys: str) -> DataFrame:
    """Rows in each window of event time and key (an extension)."""
    window = F.window(time_column, width)
    return _timed(rows, time_column, delay).groupBy(window.alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))


def supervise(
    start: Callable[[SparkSession], StreamingQuery], session: Callable[[], SparkSession], attempts: int = 5, backoff: float = 3.0
) -> int:
    """Run a query until it ends by itself; restart it after failures, waiting backoff * attempt.

    A fresh session comes from `session` each time. Returns the number of attempts; the
    last failure is raised.
    """
    for attempt in range(1, attempts + 1):
        try:
            start(session()).awaitTermination()
            return attempt
        except StreamingQueryException:
            if attempt == attempts:
                raise
            time.sleep(backoff * attempt)
    raise ValueError("attempts must be positive")
