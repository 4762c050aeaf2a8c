"""File scans: projection and filters are left to the reader's pushdown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators.clean import require_rows
from tidecast.sources.schemas import ACTUALS, BACKTEST_DETAIL, PREDICTION_LOG, RAW_COUNTS, STATION_DAYS, SUMMARY_HISTORY


def scan(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options: str) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return scan(spark, path, "csv", schema, header="true")


def ridership(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    mode: str | None = "Subway",
    columns: Sequence[str] = ("date", "mode", "count"),
    limit: int | None = None,
) -> DataFrame:
    """Raw count rows of one mode (exact match, pushed to the scan).

    Rows are ordered only when a ``limit`` makes order matter: a distributed top-n.
    """
    df = scan(spark, path, fmt, RAW_COUNTS)
    if mode is not None:
        df = df.where(F.col("mode") == mode)
    df = df.select(*columns)
    return df if limit is None else df.orderBy("date").limit(limit)


def actuals_on(spark: SparkSession, path: str, days: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Actuals of a few given days, as a pushed-down list filter; no days, no rows."""
    df = scan(spark, path, fmt, ACTUALS)
    return df.where(F.col("date").isin([F.lit(d).cast("date") for d in days])) if days else df.limit(0)


def counts_on(spark: SparkSession, path: str, days: DataFrame, mode: str | None = "Subway") -> DataFrame:
    """Counts of a mode (exact match) on the days of a table, from a ``write_by_month`` table; its columns as they are.

    The days stay in Spark: their months prune the partitions while the query runs, and the mode
    is a filter of the scan. Repeated days count once, null days nowhere.
    """
    df = scan(spark, path)
    if mode is not None:
        df = df.where(F.col("mode") == mode)
    wanted = days.where(F.col("date").isNotNull()).select(F.date_format("date", "yyyy-MM").alias("month"), "date").distinct()
    return df.withColumn("month", F.col("month").cast("string")).join(wanted, ["month", "date"], "left_semi").drop("month")


def prediction_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return scan(spark, path, fmt, PREDICTION_LOG, **({"header": "true"} if fmt == "csv" else {}))


def backtest_detail(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return scan(spark, path, fmt, BACKTEST_DETAIL, **({"header": "true"} if fmt == "csv" else {}))


def summary_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return scan(spark, path, fmt, SUMMARY_HISTORY, **({"header": "true"} if fmt == "csv" else {}))


def station_days(spark: SparkSession, path: str, start: str, end: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Station observations in [start, end]; an empty result is an error."""
    df = scan(spark, path, fmt, STATION_DAYS, **({"header": "true"} if fmt == "csv" else {}))
    df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end).cast("date"))
    return require_rows(df, "station observations")


def first_usable(
    candidates: Sequence[DataFrame | None], needed: Sequence[str], mode: str | None = "iterative"
) -> DataFrame | None:
    """The first frame that has the needed columns and, if asked, a row of the mode.

    Column checks run no job; a mode check stops at the first row found.
    """
    for df in candidates:
        if df is None or not set(needed) <= set(df.columns):
            continue
        if mode is None or not df.where(F.lower("mode") == mode).isEmpty():
            return df
    return None
