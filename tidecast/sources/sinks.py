"""Sinks: append log, overwrite tables, nested JSON, keyed upsert."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.weekly import replaced, unique_rows


def write_committed(df: DataFrame, path: str, info: dict | None = None, keep: int = 2) -> dict:
    """Replace a table as a whole and return its record: folder, rows, nulls by column and ``info``.

    The rows go to a folder of a new name; the table is what the newest record names, so a
    write that fails leaves the one before in place. Rows and nulls are counted while they are
    written. The newest ``keep`` records and their folders stay.
    """
    spark, seen, name = df.sparkSession, Observation(), f"rows-{uuid.uuid4().hex[:12]}"
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in df.columns]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls).write.parquet(f"{path}/{name}")
    counted = seen.get
    record = {"folder": name, "rows": counted["rows"], "nulls": {c: counted[f"null_{c}"] for c in df.columns}} | (info or {})
    found = versions(spark, path)
    _commit(spark, path, found[-1] + 1 if found else 1, record)
    found = versions(spark, path)
    used = {manifest(spark, path, v)["folder"] for v in found[-keep:]}
    store, base = _folder(spark, path)
    for version in found[:-keep]:
        store.delete(_folder(spark, f"{path}/{MANIFEST}/{version:010d}.json")[1], False)
    for folder in store.listStatus(base):
        if folder.getPath().getName().startswith("rows-") and folder.getPath().getName() not in used:
            store.delete(folder.getPath(), True)
    return record


def committed_record(spark: SparkSession, path: str) -> dict | None:
    """The newest record of a ``write_committed`` table, or None before its first write."""
    found = versions(spark, path)
    return manifest(spark, path, found[-1]) if found else None


def read_committed(spark: SparkSession, path: str) -> DataFrame | None:
    record = committed_record(spark, path)
    return None if record is None else spark.read.parquet(f"{path}/{record['folder']}")


def append_predictions(
    predictions: DataFrame, path: str, as_of: Column, keys: Sequence[str] = ("series_id",), fmt: str = "parquet"
) -> None:
    """Append (keys, target_date, predicted, predicted_at) to the prediction log."""
    rows = predictions.select(*keys, "target_date", "predicted", as_of.cast("timestamp").alias("predicted_at"))
    options = {"header": "true"} if fmt == "csv" else {}
    rows.write.format(fmt).options(**options).mode("append").save(path)


def overwrite_table(df: DataFrame, path: str, columns: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """Replace a result table, with a fixed column order if given."""
    rows = df.select(*columns) if columns else df
    options = {"header": "true"} if fmt == "csv" else {}
    rows.write.format(fmt).options(**options).mode("overwrite").save(path)


def write_by_month(rows: DataFrame, path: str, date: str = "date") -> None:
    """Replace a table of dated rows, with a folder a month for readers that look for a few days."""
    month = F.date_format(date, "yyyy-MM")
    rows.withColumn("month", month).repartition("month").write.mode("overwrite").partitionBy("month").parquet(path)


def weekly_json(numbers: DataFrame, as_of: Column) -> DataFrame:
    """Weekly numbers as one JSON text column, dates as text."""
    return numbers.select(
        F.to_json(F.struct("*", as_of.cast("timestamp").alias("calculation_timestamp"))).alias("value")
    )


def write_weekly_json(numbers: DataFrame, path: str, as_of: Column) -> None:
    weekly_json(numbers, as_of).write.mode("overwrite").text(path)


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing.getCondition()):
            return None
        raise


MANIFEST, STAGED = "_manifest", "_staged"
BUCKETS = 32


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of a keyed table, oldest first, from the names of its manifests."""
    store, folder = _folder(spark, f"{path}/{MANIFEST}")
    if not store.exists(folder):
        return []
    names = [f.getPath().getName() for f in store.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit() and n.endswith(".json"))


def manifest(spark: SparkSession, path: str, version: int) -> dict:
    """``buckets``, their number, and ``folders``, the folder that holds each bucket's rows."""
    store, name = _folder(spark, f"{path}/{MANIFEST}/{version:010d}.json")
    stream = store.open(name)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, version: int, content: dict) -> None:
    """The manifest appears whole under its name, or not at all; a second writer of the version fails."""
    store, name = _folder(spark, f"{path}/{MANIFEST}/{version:010d}.json")
    if store.exists(name):
        raise ValueError(f"version {version} of {path} has been written by another job")
    draft = _folder(spark, f"{path}/{MANIFEST}/.{uuid.uuid4().hex}")[1]
    stream = store.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    if not store.rename(draft, name):
        raise ValueError(f"version {version} of {path} has been written by another job")


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _rows(spark: SparkSession, path: str, content: dict, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """Rows of some buckets, or of all, as a manifest lists them; their columns are those of all files."""
    chosen = sorted(content["folders"].items()) if buckets is None else [(str(b), content["folders"].get(str(b))) for b in buckets]
    folders = [f"{path}/{folder}" for _, folder in chosen if folder]
    return spark.read.schema(T.StructType.fromJson(content["schema"])).parquet(*folders) if folders else None


def read_keyed(spark: SparkSession, path: str) -> DataFrame | None:
    """Current rows of a keyed table, newest first if it was written so, or None before its first write."""
    found = versions(spark, path)
    if not found:
        return None
    content = manifest(spark, path, found[-1])
    rows = _rows(spark, path, content)
    return rows.orderBy(F.col(content["newest_first"]).desc()) if content["newest_first"] else rows


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """Values of a whole-number partition column that have files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    found = [f.getPath().getName() for f in store.listStatus(folder) if f.isDirectory()]
    return [int(n.removeprefix(f"{column}=")) for n in found if n.startswith(f"{column}=")]


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[int]) -> None:
    """Remove the folders of some values of a partition column."""
    for value in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def upsert_keyed(
    new: DataFrame,
    path: str,
    on: Sequence[str],
    newest_first: str | None = None,
    order: str | None = None,
    keep: int = 3,
    buckets: int = BUCKETS,
) -> None:
    """Replace rows with the same key, keep the others, as a new version of the table.

    Rows lie in ``buckets`` folders by the hash of their key (the number is set by the first
    write). A write reads and writes only the buckets that its keys fall into, each to a folder of
    a new name; then a manifest that lists the folders of all buckets makes the version. Without it
    nothing has changed, so a failed write leaves the table as it was, and its folders are
    removed by a later one. A bucket is one task, so there should be enough of them. One job may write at a
    time; a second one fails when it commits. The new rows are worked out once: made unique they go
    to a hidden folder of the table, from which the three steps of the write read them.

    Of several new rows of a key the one with the largest ``order`` counts; without an order
    column a doubled key is an error. ``newest_first`` is the column to read the table by. The newest ``keep``
    versions stay, for readers of the one before and for going back.
    """
    spark = new.sparkSession
    found = versions(spark, path)
    content = manifest(spark, path, found[-1]) if found else {"buckets": buckets, "folders": {}}
    version = found[-1] + 1 if found else 1

    def bucket(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*on), F.lit(content["buckets"])).cast("int"))

    name = f"{version:010d}-{uuid.uuid4().hex[:12]}"
    unique = unique_rows(new, on, order)
    unique.write.parquet(f"{path}/{STAGED}/{name}")
    staged = spark.read.schema(unique.schema).parquet(f"{path}/{STAGED}/{name}")
    touched = sorted(r[0] for r in bucket(staged).select("_bucket").distinct().collect())
    old = _rows(spark, path, content, touched)
    rows = staged if old is None else replaced(old, staged, on)
    placed = bucket(rows).withColumn("_version", F.lit(name)).repartition(max(1, len(touched)), "_bucket")
    placed.write.mode("append").partitionBy("_bucket", "_version").parquet(path)
    folders = content["folders"] | {str(b): f"_bucket={b}/_version={name}" for b in touched}
    now = {"buckets": content["buckets"], "folders": folders, "schema": rows.schema.jsonValue(), "newest_first": newest_first}
    _commit(spark, path, version, now)
    _tidy(spark, path, max(1, keep))


def _tidy(spark: SparkSession, path: str, keep: int) -> None:
    """Remove old manifests, the folders that none of the others lists, those of failed writes too, and staged rows."""
    store, base = _folder(spark, path)
    store.delete(_folder(spark, f"{path}/{STAGED}")[1], True)
    found = versions(spark, path)
    used = {f for v in found[-keep:] for f in manifest(spark, path, v)["folders"].values()}
    for version in found[:-keep]:
        store.delete(_folder(spark, f"{path}/{MANIFEST}/{version:010d}.json")[1], False)
    for bucket in partition_values(spark, path, "_bucket"):
        for folder in store.listStatus(_folder(spark, f"{path}/_bucket={bucket}")[1]):
            if f"_bucket={bucket}/{folder.getPath().getName()}" not in used:
                store.delete(folder.getPath(), True)
