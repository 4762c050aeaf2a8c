"""Saved pages of a trade listing: written as page documents, read by a source that takes filters and columns."""

from __future__ import annotations

import json
import operator
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidecast.sources.message_files import opened
from tidecast.sources.trades import paged_listing

COLUMNS = {"trade_id": "BIGINT", "ticker": "STRING", "ts": "BIGINT", "page": "BIGINT", "place": "INT"}
ARROW = {"BIGINT": pa.int64(), "STRING": pa.string(), "INT": pa.int32()}
PAGES_OF_RANGE = 1000
ROWS_OF_BATCH = 10_000
FOLDER = re.compile(r"range=(\d+)_(-?\d*)_(-?\d*)$")
COMPARED: dict[type, Callable] = {
    EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le,
}
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def write_pages(trades: DataFrame, path: str, limit: int, pages_of_range: int = PAGES_OF_RANGE) -> None:
    """The listing in (ts, trade_id) order as documents of ``limit`` trades, one a line.

    Each ``pages_of_range`` pages are a folder that is named after its least and largest time,
    so a reader knows the folders it can leave out. A page is one group of ``limit`` rows and a
    range one of ``pages_of_range`` pages, whatever the tickers; null times and tickers stay null.
    """
    trade = F.struct("place", "trade_id", "ticker", "ts")
    placed = paged_listing(trades.select("trade_id", "ticker", "ts"), limit)
    pages = placed.groupBy("page").agg(F.sort_array(F.collect_list(trade)).alias("trades"), F.min("ts").alias("least"), F.max("ts").alias("most"))
    pages = pages.withColumn("number", F.floor(F.col("page") / pages_of_range))
    within = Window.partitionBy("number")
    ends = [F.coalesce(end.over(within).cast("string"), F.lit("")) for end in (F.min("least"), F.max("most"))]
    named = pages.withColumn("range", F.concat_ws("_", F.col("number").cast("string"), *ends))
    lines = named.select("range", F.to_json(F.struct("page", "trades"), {"ignoreNullFields": "false"}).alias("value"))
    lines.write.partitionBy("range").text(path)


@dataclass
class PageRange(InputPartition):
    """The documents of one folder."""

    folder: str


def usable(f: Filter) -> bool:
    return len(f.attribute) == 1 and f.attribute[0] in COLUMNS


class PageReader(DataSourceReader):
    def __init__(self, path: str, columns: Sequence[str]):
        self.path, self.columns = path, list(columns)
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons with a value, lists of values and null tests are decided here, all others by Spark."""
        for f in filters:
            if isinstance(f, (*COMPARED, In, IsNotNull)) and usable(f):
                self.filters.append(f)
            else:
                yield f

    def keeps(self, row: dict) -> bool:
        for f in self.filters:
            value = row[f.attribute[0]]
            if value is None:
                return False
            if isinstance(f, In) and value not in f.value:
                return False
            if type(f) in COMPARED and (f.value is None or not COMPARED[type(f)](value, f.value)):
                return False
        return True

    def may_hold(self, least: int | None, most: int | None) -> bool:
        """Whether a range of times can have a row that all filters keep."""
        for f in self.filters:
            if f.attribute[0] != "ts":
                continue
            if least is None or most is None:
                return False
            if isinstance(f, In) and not any(v is not None and least <= v <= most for v in f.value):
                return False
            if isinstance(f, EqualTo) and not (f.value is not None and least <= f.value <= most):
                return False
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and (f.value is None or not COMPARED[type(f)](most, f.value)):
                return False
            if isinstance(f, (LessThan, LessThanOrEqual)) and (f.value is None or not COMPARED[type(f)](least, f.value)):
                return False
        return True

    def partitions(self) -> list[PageRange]:
        system, folder = opened(self.path)
        found = []
        for info in system.get_file_info(fs.FileSelector(folder)):
            name = FOLDER.search(info.path)
            if name and info.type == fs.FileType.Directory:
                least, most = (int(x) if x else None for x in name.group(2, 3))
                if self.may_hold(least, most):
                    found.append((int(name[1]), PageRange(info.path)))
        return [r for _, r in sorted(found, key=lambda x: x[0])] or [PageRange("")]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        if partition.folder:
            system, _ = opened(self.path)
            files = sorted(f.path for f in system.get_file_info(fs.FileSelector(partition.folder)) if f.base_name[0] not in "_." and f.type == fs.FileType.File)
            for file in files:
                with system.open_input_stream(file) as stream:
                    for line in lines_of(stream):
                        page = json.loads(line)
                        held += [row for trade in page["trades"] if self.keeps(row := {**trade, "page": page["page"]})]
                        if len(held) >= ROWS_OF_BATCH:
                            yield self._batch(held)
                            held = []
        yield self._batch(held)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        arrays = [pa.array([r[c] for r in rows], ARROW[COLUMNS[c]]) for c in self.columns]
        return pa.RecordBatch.from_arrays(arrays, names=self.columns)


def lines_of(stream: pa.NativeFile, size: int = 1 << 20) -> Iterator[bytes]:
    """Lines that aren't empty."""
    rest = b""
    while block := stream.read(size):
        *whole, rest = (rest + block).split(b"\n")
        yield from filter(None, whole)
    if rest:
        yield rest


class ListingPages(DataSource):
    """Page documents as ``write_pages`` leaves them.

    ``columns`` chooses columns (all without it); one task reads one range of pages, those whose
    times no filter wants are left out by their names alone. The driver lists folder names only.
    A folder without pages, or an empty listing, gives no rows. The reader takes filters, which
    Spark allows only with ``spark.sql.python.filterPushdown.enabled``.
    """

    @classmethod
    def name(cls) -> str:
        return "listing_pages"

    def chosen(self) -> list[str]:
        names = [c.strip() for c in self.options.get("columns", ",".join(COLUMNS)).split(",")]
        unknown = [c for c in names if c not in COLUMNS]
        if unknown or len(set(names)) < len(names):
            raise ValueError(f"columns must be some of {', '.join(COLUMNS)}, each once")
        return names

    def schema(self) -> str:
        return ", ".join(f"{c} {COLUMNS[c]}" for c in self.chosen())

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(self.options["path"], self.chosen())


def saved_listing(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The trades of saved pages; see ``ListingPages``. Allows the session's Python sources to take filters."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(ListingPages)
    reader = spark.read.format("listing_pages").option("path", path)
    return (reader.option("columns", ",".join(columns)) if columns else reader).load()
