"""Metrics and biases from a table of error sums that each backtest run adds its cutoffs to.

A row holds what the errors of one key, cutoff, mode, step and target weekday add up to, so a new
cutoff costs its own rows, and every metric that is a mean of errors is read off sums of a
handful of rows a key. A calibrated mean absolute error isn't one: it needs the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.dates import weekday
from tidecast.operators.evaluate import PAIR, all_modes, cheapest_switch, sweep_of_steps
from tidecast.operators.forecast import MODES

SUMS = ("n", "abs", "sq", "sum")


def error_sums(detail: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """(keys, train_end, mode, step, weekday, n, abs, sq, sum); modes in lower case, rows without error count nowhere."""
    at = [*keys, "train_end", F.lower("mode").alias("mode"), "step", weekday(F.col("target_date")).alias("weekday")]
    return detail.groupBy(*at).agg(
        F.count("error").alias("n"), F.sum("abs_error").alias("abs"), F.sum("squared_error").alias("sq"), F.sum("error").alias("sum")
    )


def store_error_sums(detail: DataFrame, path: str, keys: Sequence[str] = ("series_id",)) -> None:
    """Add a run's cutoffs to the table. A cutoff that is there already is replaced, so a run may be repeated.

    A run must hold all keys of its cutoffs; it touches no other cutoff's files.
    """
    writer = error_sums(detail, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("train_end").parquet(path)


def read_error_sums(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The table, or its cutoffs from a day on: those are partitions, others aren't read."""
    sums = spark.read.parquet(path).withColumn("train_end", F.col("train_end").cast("date"))
    return sums if since is None else sums.where(F.col("train_end") >= F.lit(since).cast("date"))


def _added(sums: DataFrame, groups: Sequence[str]) -> DataFrame:
    return sums.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in SUMS])


def _means() -> list[Column]:
    means = [F.try_divide(c, "n").alias(name) for c, name in (("abs", "MAE"), ("sq", "MSE"), ("sum", "MeanError"))]
    return [F.col("n").alias("count"), *means]


def overall_metrics(sums: DataFrame, keys: Sequence[str] = (), modes: Sequence[str] = MODES) -> DataFrame:
    """As ``evaluate.overall_metrics`` of the rows summed."""
    return all_modes(_added(sums, [*keys, "mode"]).select(*keys, "mode", *_means()), keys, modes)


def horizon_metrics(sums: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return _added(sums, [*keys, "mode", "step"]).select(*keys, "mode", "step", *_means())


def _negative_mean(own: Column) -> Column:
    return F.coalesce(-F.try_divide(F.sum(F.when(own, F.col("sum"))), F.sum(F.when(own, F.col("n")))), F.lit(0.0))


def global_bias(sums: DataFrame, keys: Sequence[str] = (), mode: str = "iterative") -> DataFrame:
    return sums.groupBy(*keys).agg(_negative_mean(F.col("mode") == mode).alias("bias"))


def weekday_bias(sums: DataFrame, keys: Sequence[str] = (), mode: str = "iterative") -> DataFrame:
    """(keys, weekday, bias) for all seven weekdays, 0 where there is no error."""
    means = [_negative_mean((F.col("mode") == mode) & (F.col("weekday") == k)).alias(f"_{k}") for k in range(7)]
    biases = F.posexplode(F.array(*[f"_{k}" for k in range(7)])).alias("weekday", "bias")
    return sums.groupBy(*keys).agg(*means).select(*keys, biases)


def _sides(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, step) with each sum of the iterated and the direct mode."""
    return sums.groupBy(*keys, "step").agg(
        *[F.sum(F.when(F.col("mode") == mode, F.col(c))).alias(f"{c}{side}") for mode, side in zip(PAIR, ("_it", "_mu")) for c in SUMS]
    )


def switch_sweep(sums: DataFrame, keys: Sequence[str] = (), switches: int = 7) -> DataFrame:
    """Errors of the uncalibrated hybrid for each switch."""
    return sweep_of_steps(_sides(sums, keys), keys, switches)


def best_switch(sums: DataFrame, keys: Sequence[str] = (), horizon: int | DataFrame = 7) -> DataFrame:
    """As ``evaluate.best_switch`` of the rows summed; ``horizon`` is a number or a frame (keys, horizon)."""
    means = [F.try_divide("abs_it", "n_it").alias("it"), F.try_divide("abs_mu", "n_mu").alias("mu")]
    return cheapest_switch(_sides(sums, keys).select(*keys, "step", F.lit(None).cast("int").alias("_h"), *means), keys, horizon)
