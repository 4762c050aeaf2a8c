"""Message segments as a stream source of their own: offsets, byte ranges, commits."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "segment STRING, position BIGINT, value STRING"
RANGE_BYTES = 32 << 20
ROWS_OF_BATCH = 10_000
BLOCK = 1 << 16


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def segments(path: str) -> list[tuple[str, int]]:
    """(name below the folder, bytes) of all segments by name; names that begin with ``_`` or ``.`` don't count."""
    system, folder = opened(path)
    found = system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
    named = [(f.path[len(folder.rstrip("/")) + 1 :], f.size) for f in found if f.type == fs.FileType.File]
    return sorted((name, size) for name, size in named if not any(part[0] in "_." for part in name.split("/")))


def whole_lines(path: str, name: str, size: int) -> int:
    """How many of a segment's first ``size`` bytes end with a line; read from the back."""
    system, folder = opened(path)
    with system.open_input_file(f"{folder}/{name}") as file:
        end = size
        while end:
            begin = max(0, end - BLOCK)
            at = file.read_at(end - begin, begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return 0


@dataclass
class Range(InputPartition):
    """The lines that begin in some bytes of a segment; ``limit`` is where the batch ends in it."""

    name: str
    begin: int
    end: int
    limit: int
    at_line: bool


class MessageReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.committed = options.get("committed")

    def initialOffset(self) -> dict:
        return {"segment": "", "position": 0}

    def latestOffset(self) -> dict:
        """The end of the last whole line of the newest segment that has one."""
        for name, size in reversed(segments(self.path)):
            if end := whole_lines(self.path, name, size):
                return {"segment": name, "position": end}
        return self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        ranges = []
        for name, size in segments(self.path):
            if start["segment"] <= name <= end["segment"]:
                first = start["position"] if name == start["segment"] else 0
                limit = end["position"] if name == end["segment"] else size
                for begin in range(first, limit, self.range_bytes):
                    ranges.append(Range(name, begin, min(begin + self.range_bytes, limit), limit, begin == first))
        return ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        system, folder = opened(self.path)
        with system.open_input_file(f"{folder}/{partition.name}") as raw, io.BufferedReader(raw, BLOCK) as file:
            at = partition.begin
            if not partition.at_line:
                # a line that begins before the range belongs to the range before
                file.seek(at - 1)
                at += len(file.readline()) - 1
            file.seek(at)
            places, values = [], []
            while at < partition.end:
                line = file.readline()
                if not line:
                    break
                places.append(at)
                values.append(line.rstrip(b"\n").decode("utf-8", "replace"))
                at += len(line)
                if len(places) == ROWS_OF_BATCH:
                    yield self._batch(partition.name, places, values)
                    places, values = [], []
            yield self._batch(partition.name, places, values)

    @staticmethod
    def _batch(name: str, places: list[int], values: list[str]) -> pa.RecordBatch:
        arrays = [pa.array([name] * len(places), pa.string()), pa.array(places, pa.int64()), pa.array(values, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=["segment", "position", "value"])

    def commit(self, end: dict) -> None:
        """Leave the end of what is done in the ``committed`` file; segments before it may be taken away."""
        if self.committed:
            system, target = opened(self.committed)
            with system.open_output_stream(f"{target}.new") as file:
                file.write(json.dumps(end).encode())
            system.move(f"{target}.new", target)


class MessageFiles(DataSource):
    """Append-only segments of one message a line.

    Segments are read by name; a new one must sort after all others, and only the newest may
    still grow. An offset is a segment and a byte in it, so a checkpoint's size doesn't depend on
    the number of segments. A last line without its line break waits for it, but only in the
    newest segment; elsewhere it is a message. Bytes that aren't UTF-8 become U+FFFD. Empty lines
    are empty messages. The driver lists names and sizes; lines are read by tasks, each
    ``range_bytes`` of a segment.
    """

    @classmethod
    def name(cls) -> str:
        return "message_files"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> MessageReader:
        return MessageReader(dict(self.options))


def message_stream(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, committed: str | None = None) -> DataFrame:
    """(segment, position, value) of the messages below ``path`` as a stream; see ``MessageFiles``."""
    spark.dataSource.register(MessageFiles)
    reader = spark.readStream.format("message_files").option("path", path).option("range_bytes", range_bytes)
    return (reader.option("committed", committed) if committed else reader).load()
