"""Text files as a stream that releases a bounded number of lines for each second passed.

An offset says up to which byte of which file lines have been released, and when that was. The next one
lies at most `rate` lines for each second since then further on, and not more than `burst` seconds' worth after a pause.
The driver looks for these line ends only, that is through what it releases; tasks read the
bytes between two offsets. As offsets hold all that the pace depends on, a restart goes on where the
checkpoint ends, at the same pace.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

BLOCK = 1 << 20


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """A folder of any file system that Arrow knows by its URI, or of the local one."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Lines(InputPartition):
    """Whole lines of one file."""

    file: str
    start: int
    end: int

    def __post_init__(self):
        super().__init__(None)


class PacedReader(DataSourceStreamReader):
    """Files in the order of their names. Files are complete when they appear, and later ones have later names."""

    def __init__(self, path: str, rate: float, burst: float = 10.0, part: int = 64 << 20, clock: Callable[[], float] = time.time):
        if rate <= 0:
            raise ValueError("rate must be positive")
        self.path, self.rate, self.burst, self.part, self.clock = path, rate, burst, part, clock
        self._last: dict | None = None

    def initialOffset(self) -> dict:
        self._last = {"file": "", "at": 0, "time": self.clock(), "owed": 0.0}
        return self._last

    def _files(self) -> list[tuple[str, int]]:
        system, folder = open_folder(self.path)
        found = system.get_file_info(fs.FileSelector(folder))
        return sorted((x.base_name, x.size) for x in found if x.is_file and not x.base_name.startswith((".", "_")))

    def latestOffset(self) -> dict:
        last = self.initialOffset() if self._last is None else self._last
        now = self.clock()
        due = min(last["owed"] + max(now - last["time"], 0.0) * self.rate, self.burst * self.rate)
        lines, at, file = int(due), last["at"], last["file"]
        released = 0
        for name, size in self._files():
            if name < file or released == lines:
                continue
            start = at if name == file else 0
            n, end = self._skip(name, start, size, lines - released)
            if n:
                file, at, released = name, end, released + n
        if released == 0:
            return last  # time goes on counting until a line is due
        # What is owed beyond the lines there are is forgotten: a pause doesn't make a burst later.
        self._last = {"file": file, "at": at, "time": now, "owed": due - released if released == lines else 0.0}
        return self._last

    def _skip(self, name: str, start: int, size: int, most: int) -> tuple[int, int]:
        """How many of `most` whole lines there are from a byte on, and where they end. A last line without an end is whole."""
        system, folder = open_folder(self.path)
        n, at = 0, start
        with system.open_input_file(f"{folder}/{name}") as f:
            while n < most and at < size:
                data = f.read_at(min(BLOCK, size - at), at)
                here = data.count(b"\n")
                if n + here >= most:
                    end = -1
                    for _ in range(most - n):
                        end = data.find(b"\n", end + 1)
                    return most, at + end + 1
                n, at = n + here, at + len(data)
                if at >= size and not data.endswith(b"\n"):
                    n += 1
        return n, at

    def partitions(self, start: dict, end: dict) -> Sequence[Lines]:
        # After a restart Spark tells where the checkpoint ends by asking for the parts of an empty range.
        self._last = end if self._last is None else self._last
        out = []
        for name, size in self._files():
            if start["file"] <= name <= end["file"]:
                a = start["at"] if name == start["file"] else 0
                b = end["at"] if name == end["file"] else size
                out += [Lines(name, x, min(x + self.part, b)) for x in range(a, b, self.part)]
        return out

    def read(self, partition: Lines) -> Iterator[tuple]:
        """The lines that begin in a part, as a text source gives them."""
        system, folder = open_folder(self.path)
        with system.open_input_file(f"{folder}/{partition.file}") as f:
            at = partition.start
            if at and f.read_at(1, at - 1) != b"\n":
                at += len(_rest(f, at))
            rest = b""
            while at < partition.end:
                data = f.read_at(min(BLOCK, partition.end - at), at)
                at += len(data)
                *lines, rest = (rest + data).split(b"\n")
                for line in lines:
                    yield (_text(line),)
            if rest:
                yield (_text((rest + _rest(f, at)).removesuffix(b"\n")),)

    def commit(self, end: dict) -> None:
        pass


def _rest(f, at: int) -> bytes:
    """From a byte to the end of its line, with the line's end."""
    out = b""
    while data := f.read_at(BLOCK, at):
        head, found, _ = data.partition(b"\n")
        out += head + found
        if found:
            break
        at += len(data)
    return out


def _text(line: bytes) -> str:
    return line.removesuffix(b"\r").decode("utf-8", "replace")


class PacedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paced_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> PacedReader:
        o = self.options
        return PacedReader(o["path"], float(o["rate"]), float(o.get("burst", 10)), int(o.get("part", 64 << 20)))


def paced_stream(spark: SparkSession, path: str, rate: float, burst: float = 10.0) -> DataFrame:
    """Lines of the text files in a folder as a stream of `value`, at most `rate` a second."""
    spark.dataSource.register(PacedLines)
    return spark.readStream.format("paced_lines").option("path", path).option("rate", rate).option("burst", burst).load()
