"""Ticker and event messages as streams: parse, latest per key, daily counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidecast.sources.sinks import drop_partitions, partition_values, table_or_none


def file_stream(
    spark: SparkSession, folder: str, schema, fmt: str = "parquet", files: str | None = None, per_trigger: int | None = None
) -> DataFrame:
    """Files of a folder as a stream, ``files`` a name pattern; the schema is declared."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(folder)


def parse_messages(messages: DataFrame, column: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, message, body, is_bad) for a stream or a table of JSON texts.

    A text that is not a JSON object, or whose values do not fit the schema, is bad;
    it stays in the output so that it can be stored apart.
    """
    corrupt = "_corrupt"
    parsed = F.from_json(F.col(column), f"{schema}, {corrupt} STRING", {"columnNameOfCorruptRecord": corrupt})
    out = messages.select(*keep, F.col(column).alias("message"), parsed.alias("body"))
    bad = F.col("body").isNull() | F.col(f"body.{corrupt}").isNotNull()
    return out.select(*keep, "message", F.col("body").dropFields(corrupt).alias("body"), bad.alias("is_bad"))


def once(messages: DataFrame, ident: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Messages of which a repeated delivery within ``delay`` is left out, in whichever batch it comes.

    The state holds the identities of the last ``delay`` only, so a message that is older than that
    when it comes can't be told from a repeated one and is left out too. The state belongs in the
    RocksDB store, see ``state_in_rocksdb``. Messages without time or identity are never taken as
    repeated.
    """
    told = F.col(ts).isNotNull()
    for column in ident:
        told = told & F.col(column).isNotNull()
    own = messages.withColumn("_own", F.when(told, F.lit("")).otherwise(F.uuid()))
    return own.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*ident, "_own"]).drop("_own")


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state on the executors' disks, and a checkpoint writes what a batch changed."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def store_messages(parsed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write good and bad messages to separate partitions of one table, once each, and stop."""
    return (
        parsed.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("is_bad")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_changes(events: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Newest message of each key. As a stream it keeps one row of state per key."""
    at = F.struct(*order)
    newest = F.max_by(F.struct(*order, *values), at)
    return events.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def store_latest(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append only the keys changed by each micro-batch, in a folder per batch.

    A repeated batch overwrites its own folder, so a restart changes nothing. The
    cost of a batch is its changed keys, not the size of the table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        changes.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current row of each key of a ``store_latest`` table: that of the newest message.

    Messages, not batches, are ordered: batch numbers start again when a checkpoint is lost.
    """
    log = spark.read.option("basePath", path).parquet(path)
    rest = [c for c in log.columns if c not in keys and c != "batch"]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")


def compact_latest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Replace all batches of a ``store_latest`` table by one with the current rows.

    The rows are written beside the batches first and only then are those removed; whatever
    stops in between leaves a table that reads the same. No stream may write meanwhile.
    Numbers of such batches go down from -1, away from those of streams.
    """
    old = partition_values(spark, path, "batch")
    read_latest(spark, path, keys, order).write.mode("overwrite").parquet(f"{path}/batch={min([0, *old]) - 1}")
    drop_partitions(spark, path, "batch", old)


def daily_counts(
    events: DataFrame, ts: Column, keys: Sequence[str], delay: str = "1 hour", value: Column | None = None
) -> DataFrame:
    """(keys, date, n, y) per event-time day; as a stream a day comes out when the watermark passes its end."""
    stamped = events.select(*keys, ts.cast("timestamp").alias("_ts"), (F.lit(1.0) if value is None else value).alias("_v"))
    return (
        stamped.withWatermark("_ts", delay)
        .groupBy(F.window("_ts", "1 day").alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_v").alias("y"))
        .select(*keys, F.col("_w.start").cast("date").alias("date"), "n", "y")
    )


def store_closed_days(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def store_day_parts(
    events: DataFrame, ts: Column, keys: Sequence[str], path: str, checkpoint: str, delay: str = "1 hour", value: Column | None = None
) -> StreamingQuery:
    """Append each micro-batch's counts per (keys, day), so that no row is lost and open days can be read.

    Rows that come later than ``delay`` after their day's end, by the newest event of the
    batches before, are counted too and also kept in ``late``. A repeated batch overwrites its
    own folders.
    """
    stamped = events.select(*keys, ts.cast("timestamp").alias("ts"), (F.lit(1.0) if value is None else value).alias("value"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        days = table_or_none(spark, f"{path}/days")
        newest = None if days is None else days.where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
        day = F.col("ts").cast("date")
        parts = batch.where("ts is not null").groupBy(*keys, day.alias("date")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("value").alias("y"), F.max("ts").alias("newest")
        )
        parts.write.mode("overwrite").parquet(f"{path}/days/batch={batch_id}")
        closed = F.date_add(day, 1).cast("timestamp") <= F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        batch.where(closed).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")

    return (
        stamped.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    )


def read_days(spark: SparkSession, path: str, keys: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """(keys, date, n, y, is_open) of a ``store_day_parts`` table, open days included."""
    parts = spark.read.option("basePath", f"{path}/days").parquet(f"{path}/days")
    newest = parts.agg(F.max("newest")).first()[0]
    is_open = F.date_add("date", 1).cast("timestamp") > F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    return parts.groupBy(*keys, "date").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).withColumn("is_open", is_open)


def read_late(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """(keys, ts, value) rows that came after their day was closed."""
    return spark.read.option("basePath", f"{path}/late").parquet(f"{path}/late").select(*keys, "ts", "value")
