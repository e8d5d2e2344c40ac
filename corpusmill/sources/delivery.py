"""A keyed sink for any message transport: bounded retries, growing pauses and exact counts.

Each task opens a transport, sends its rows one after the other under their key, and drops a row after `tries`
failures. How many rows were sent and dropped travels in the task's commit message, so that
attempts that Spark repeats or gives up don't count; the totals are written as JSON below the shared folder,
since Spark commits in a process of its own, and read from there.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from corpusmill.sources.paced import open_folder
from corpusmill.sources.sinks import scratch

log = logging.getLogger(__name__)


class Transport(Protocol):
    """What a broker's client does. send raises BufferError when its queue is full; flush waits for what is under way."""

    def send(self, key: str, value: str) -> None: ...

    def poll(self, seconds: float) -> None: ...

    def flush(self, seconds: float) -> None: ...


@dataclass
class Delivered(WriterCommitMessage):
    sent: int
    dropped: int


@dataclass(frozen=True)
class Policy:
    tries: int = 3
    backoff: float = 1.0  # seconds after the first failure, twice that after the second
    drain: float = 0.5  # seconds given to a full queue before that
    flush: float = 10.0  # seconds given to what is under way at the end of a task


def delivered(transport: Transport, key: str, value: str, policy: Policy, sleep: Callable[[float], None] = time.sleep) -> bool:
    """Whether one message could be handed over. A pause follows each failure, also the last."""
    for attempt in range(1, policy.tries + 1):
        try:
            transport.send(key, value)
            transport.poll(0.0)
            return True
        except BufferError as e:
            log.warning("queue full (%d of %d): %s", attempt, policy.tries, e)
            transport.poll(policy.drain)
        except Exception as e:
            log.warning("not delivered (%d of %d): %s", attempt, policy.tries, e)
        sleep(policy.backoff * attempt)
    log.error("dropped after %d tries: %s", policy.tries, key)
    return False


class _Writer(DataSourceWriter):
    def __init__(self, transport: Callable[[], Transport], policy: Policy, report: str):
        self.transport, self.policy, self.report = transport, policy, report

    def write(self, iterator: Iterator) -> Delivered:
        transport, counts = self.transport(), [0, 0]
        for row in iterator:
            counts[0 if delivered(transport, row["key"], row["value"], self.policy) else 1] += 1
        transport.flush(self.policy.flush)
        return Delivered(*counts)

    def commit(self, messages: list) -> None:
        totals = {"sent": sum(m.sent for m in messages if m), "dropped": sum(m.dropped for m in messages if m)}
        system, folder = open_folder(self.report)
        system.create_dir(folder)
        with system.open_output_stream(f"{folder}/totals.json") as f:
            f.write(json.dumps(totals).encode())

    def abort(self, messages: list) -> None:
        log.error("a task failed for good; rows of %d tasks had been sent", sum(m is not None for m in messages))


def deliver(df: DataFrame, key: str, transport: Callable[[], Transport], policy: Policy = Policy()) -> dict[str, int]:
    """Send the rows as JSON under their key, in the order of each partition. Returns how many were sent and dropped.

    `transport` makes a client in each task. A null key is sent as the empty text. A task that Spark runs again sends its
    rows again: delivery is at least once.
    """
    report = scratch(df.sparkSession)
    name = f"delivery-{uuid.uuid4().hex}"

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "key string, value string"

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return _Writer(transport, policy, report)

    df.sparkSession.dataSource.register(Source)
    rows = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.to_json(F.struct("*")).alias("value"))
    rows.write.format(name).mode("append").save()
    system, folder = open_folder(report)
    with system.open_input_stream(f"{folder}/totals.json") as f:
        return json.loads(f.read())
