"""Rolling-origin backtest of expression models.

Everything a cutoff needs (its rank, history, horizon and the values observed in
the days after it) is a window over the same series partition, so a backtest is
one exchange and one sort of the known days: no join of cutoffs to history, none
to actuals, and no filling of whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidecast.functions.dates import days_to_sunday
from tidecast.operators.forecast import HISTORY, mode_path
from tidecast.operators.models import HistoryModel, trend_value, with_running_trend
from tidecast.operators.series import KEYS, daily_values, one_per_day

MAX_STEPS = 7

DETAIL_COLUMNS = (
    "train_end",
    "mode",
    "target_date",
    "step",
    "predicted",
    "actual",
    "error",
    "abs_error",
    "squared_error",
)


def _newest_first(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(F.col("date").desc())


def _everything(keys: Sequence[str]) -> WindowSpec:
    """The whole series, in the order of the other windows so that one sort serves all."""
    return _newest_first(keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def mark_cutoffs(
    daily: DataFrame,
    keys: Sequence[str] = KEYS,
    warmup: int = 30,
    newest: int = 10,
    observed: Column | None = None,
) -> DataFrame:
    """Add ``cutoff_rank`` (1 = newest) to the rows that are backtest cutoffs, null elsewhere.

    A cutoff is an observed date at least ``warmup`` days after the first one
    whose coming Sunday is not past the last one. ``observed`` tells observed rows
    from filled ones where ``daily`` has both.
    """
    first, last = F.min("date").over(_everything(keys)), F.max("date").over(_everything(keys))
    candidate = (F.col("date") >= F.date_add(first, warmup)) & (
        F.date_add("date", days_to_sunday(F.col("date"))) <= last
    )
    if observed is not None:
        candidate = candidate & observed
    running = _newest_first(keys).rowsBetween(Window.unboundedPreceding, 0)
    return (
        daily.withColumn("_candidate", candidate)
        .withColumn("_rank", F.count_if("_candidate").over(running))
        .withColumn("cutoff_rank", F.when(F.col("_candidate") & (F.col("_rank") <= newest), F.col("_rank").cast("int")))
        .drop("_candidate", "_rank")
    )


def cutoffs(daily: DataFrame, keys: Sequence[str] = KEYS, warmup: int = 30, newest: int = 10) -> DataFrame:
    marked = mark_cutoffs(daily, keys, warmup, newest)
    return marked.where(F.col("cutoff_rank").isNotNull()).select(
        *keys, F.col("date").alias("train_end"), "cutoff_rank", days_to_sunday(F.col("date")).alias("horizon")
    )


def cutoff_rows(daily: DataFrame, keys: Sequence[str] = KEYS, warmup: int = 30, newest: int = 10) -> DataFrame:
    """One row per cutoff: ``origin``, ``horizon``, ``hist`` and ``ahead``, the known (date, y) right after it.

    Works on known days; gaps are interpolated only inside each cutoff's own
    history. As a cutoff is a known day, that equals filling the series cut there.
    Rows that no cutoff looks at are dropped before histories are collected.
    ``hist`` is empty where the series is too short.
    """
    order = _newest_first(keys)
    row = F.row_number().over(order)
    marked = mark_cutoffs(daily.where(F.col("y").isNotNull()), keys, warmup, newest).withColumn("_row", row)
    oldest = F.max(F.when(F.col("cutoff_rank").isNotNull(), F.col("_row"))).over(_everything(keys))
    near = marked.withColumn("_oldest", oldest).where(F.col("_row") < F.col("_oldest") + HISTORY)
    known = F.struct("date", "y")
    return (
        near.select(
            *keys,
            F.col("date").alias("origin"),
            "cutoff_rank",
            F.collect_list(known).over(order.rowsBetween(0, HISTORY - 1)).alias("_past"),
            F.array(*[F.lag(known, k).over(order) for k in range(1, MAX_STEPS + 1)]).alias("ahead"),
        )
        .where(F.col("cutoff_rank").isNotNull())
        .select(
            *keys,
            "origin",
            "cutoff_rank",
            days_to_sunday(F.col("origin")).alias("horizon"),
            daily_values(F.reverse("_past"), HISTORY).alias("hist"),
            "ahead",
        )
    )


def with_errors(scored: DataFrame) -> DataFrame:
    """error = predicted - actual, its absolute value and its square."""
    error = F.col("predicted") - F.col("actual")
    return scored.select("*", error.alias("error"), F.abs(error).alias("abs_error"), (error * error).alias("squared_error"))


def score_predictions(
    predictions: DataFrame, actuals: DataFrame, keys: Sequence[str] = KEYS, order: str | None = None
) -> DataFrame:
    """Stored predictions joined to observed values; predictions of unobserved days drop out.

    ``predictions`` has (keys, train_end, mode, target_date, predicted), ``actuals`` (keys, date, y).
    Of several actuals of a day the one with the largest ``order`` counts; without an
    order column a doubled day is an error.
    """
    seen = one_per_day(actuals, keys, order).select(*keys, F.col("date").alias("target_date"), F.col("y").alias("actual"))
    joined = predictions.join(seen, [*keys, "target_date"]).withColumn("step", F.date_diff("target_date", "train_end"))
    return with_errors(joined).select(*keys, *DETAIL_COLUMNS)


def run(
    daily: DataFrame,
    models: dict[str, HistoryModel],
    keys: Sequence[str] = KEYS,
    warmup: int = 30,
    newest: int = 10,
) -> DataFrame:
    """Backtest detail rows of every mode over each series' newest cutoffs."""
    steps = F.col("horizon")
    runs = F.array(
        *[F.struct(F.lit(mode).alias("mode"), mode_path(mode, m, steps).alias("path")) for mode, m in models.items()]
    )
    target = F.date_add("train_end", F.col("_pos") + 1)
    rows = (
        cutoff_rows(daily, keys, warmup, newest)
        .where(F.size("hist") == HISTORY)
        .select(*keys, F.col("origin").alias("train_end"), "ahead", F.explode(runs).alias("_run"))
        .select(*keys, "train_end", "_run.mode", "ahead", F.posexplode("_run.path").alias("_pos", "predicted"))
        .select(
            *keys,
            "train_end",
            "mode",
            target.alias("target_date"),
            (F.col("_pos") + 1).alias("step"),
            "predicted",
            F.get(F.filter("ahead", lambda known: known["date"] == target), F.lit(0))["y"].alias("actual"),
        )
        .where(F.col("actual").isNotNull())
    )
    return with_errors(rows).select(*keys, *DETAIL_COLUMNS)


def run_trend(
    filled: DataFrame, keys: Sequence[str] = KEYS, warmup: int = 30, newest: int = 10, mode: str = "trend"
) -> DataFrame:
    """Backtest detail rows of the trend line fitted to all days up to each cutoff.

    The line is a running aggregate over the filled series, read off at the
    cutoffs, so the fits cost one pass however many cutoffs there are.
    """
    order = Window.partitionBy(*keys).orderBy("date")
    seen = F.when(~F.col("is_filled"), F.col("y"))
    marked = with_running_trend(mark_cutoffs(filled, keys, warmup, newest, ~F.col("is_filled")), keys)
    steps = (
        marked.select("*", F.array(*[F.lead(seen, k).over(order) for k in range(1, MAX_STEPS + 1)]).alias("_ahead"))
        .where(F.col("cutoff_rank").isNotNull())
        .withColumnRenamed("date", "train_end")
        .select("*", F.explode(F.sequence(F.lit(1), days_to_sunday(F.col("train_end")))).alias("step"))
    )
    target = F.date_add("train_end", F.col("step"))
    rows = steps.select(
        *keys,
        "train_end",
        F.lit(mode).alias("mode"),
        target.alias("target_date"),
        "step",
        trend_value(target).alias("predicted"),
        F.get("_ahead", F.col("step") - 1).alias("actual"),
    ).where(F.col("actual").isNotNull())
    return with_errors(rows).select(*keys, *DETAIL_COLUMNS)


def skipped(
    daily: DataFrame,
    modes: Sequence[str] = ("single", "multi", "iterative"),
    keys: Sequence[str] = KEYS,
    warmup: int = 30,
    newest: int = 10,
) -> DataFrame:
    """(cutoff, mode) pairs that cannot be run, with the reason; the others are unaffected."""
    return (
        cutoff_rows(daily, keys, warmup, newest)
        .where(F.size("hist") < HISTORY)
        .select(
            *keys,
            F.col("origin").alias("train_end"),
            F.explode(F.array(*[F.lit(m) for m in modes])).alias("mode"),
            F.lit(f"fewer than {HISTORY} days of history").alias("reason"),
        )
    )
