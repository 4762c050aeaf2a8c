"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import string
import sys
import types
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import fresh_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a new folder of the shared checkpoint folder; the table read back, and its path.

    The table cuts the lineage: what follows reads it again after a lost executor.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def saved(df: DataFrame, name: str) -> DataFrame:
    return saved_at(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``saved_at`` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only, whatever the locale and script."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def hex_number(text: Column, digits: int) -> Column:
    """The first ``digits`` (at most 15) hex digits of ``text`` as a long."""
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("long")


def root_buckets(rows: int) -> int:
    """A power of two near the square root of ``rows``.

    Ranks are counted per bucket and then over the list of buckets; with this many,
    neither a bucket nor the list outgrows the square root of the table.
    """
    return 1 << max(0, (max(rows, 1).bit_length()) // 2)


def kept_in_process() -> dict:
    """What a Python worker keeps from one task to the next."""
    return sys.modules.setdefault("_tidecast_kept", types.ModuleType("_tidecast_kept")).__dict__


def letters() -> np.ndarray:
    """For each code point whether it is a letter; one table per worker process."""
    kept = kept_in_process()
    if "letters" not in kept:
        kept["letters"] = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return kept["letters"]


def chunks(texts: Sequence[str], chars: int = 1 << 20) -> Iterator[tuple[int, Sequence[str]]]:
    """(number of the first, texts) in runs of about ``chars`` code points, so that arrays over them stay small."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= chars:
            yield first, texts[first : i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def few_rows(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, a few at a time, so that what a task makes of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
