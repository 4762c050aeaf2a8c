"""The weekly forecast job: backtest, calibrate, forecast, roll up.

Every stage writes its table and the next one reads it back, so a lost executor
costs one stage at most and a skipped stage uses what an earlier run wrote. A table
counts once its record is there, so a stage that fails in the middle leaves the one before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.dates import days_to_sunday
from tidecast.operators import backtest as bt
from tidecast.operators import learners
from tidecast.operators.evaluate import apply_bias, best_switch, weekday_bias
from tidecast.operators.forecast import compose_hybrid, forecast, origins
from tidecast.operators.models import HistoryModel
from tidecast.operators.series import KEYS, between_dates, fill_gaps, one_per_day
from tidecast.operators.weekly import skipped_weeks, summary_rows, week_days, weekly_numbers
from tidecast.sources.sinks import (
    append_predictions,
    committed_record,
    read_committed,
    read_keyed,
    table_or_none,
    upsert_keyed,
    write_committed,
    write_weekly_json,
)

STAGES = ("backtest", "calibrate", "forecast", "rollup")
#: Tables that a run replaces, and the stage that does.
TABLES = {"series": "series", "backtest": "backtest", "bias": "calibrate", "switch": "calibrate", "weekly": "rollup", "weekly_skipped": "rollup"}


def _uses_learners(models: dict) -> bool:
    return any(isinstance(m, learners.Learner) for m in models.values())


def weekly_run(
    spark: SparkSession,
    daily: DataFrame,
    base: str,
    as_of: str,
    models: dict[str, HistoryModel] | dict[str, learners.Learner] = learners.FORECAST_LEARNERS,
    *,
    backtest_models: dict[str, HistoryModel] | dict[str, learners.Learner] | None = None,
    keys: Sequence[str] = KEYS,
    skip: Sequence[str] = (),
    switch: int | None = None,
    bias: float | None = None,
    allow_partial: bool = False,
    warmup: int = 30,
    newest: int = 10,
    span: tuple[str | None, str | None] | None = None,
    order: str | None = None,
    keep_versions: int = 3,
) -> dict[str, DataFrame]:
    """Run the stages over daily rows (keys, date, y) and return the tables written under ``base``.

    ``models`` maps single, multi and iterative to expression models or pooled
    learners, by default the documented learners with their own backtest settings.
    ``backtest_models`` may differ from ``models``. ``switch`` and ``bias`` override the calibration. The first failing
    stage stops the run. ``span`` cuts the series to a closed range of dates; of several rows
    of a day the one with the largest ``order`` column counts, and without one a doubled day
    is an error. Weeks that can't be averaged are listed in the table ``weekly_skipped``.
    """
    unknown = set(skip) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    if backtest_models is None:
        backtest_models = learners.BACKTEST_LEARNERS if models is learners.FORECAST_LEARNERS else models
    run_time = F.lit(as_of).cast("timestamp")
    pooled = _uses_learners(models)
    path = {name: f"{base}/{name}" for name in (*TABLES, "predictions", "summary")}

    def write(rows: DataFrame, name: str) -> None:
        write_committed(rows, path[name], {"stage": TABLES[name], "as_of": as_of})

    def read(name: str) -> DataFrame:
        rows = read_committed(spark, path[name])
        if rows is None:
            raise ValueError(f"no table {name} under {base}: stage {TABLES[name]} has not been run")
        return rows

    # Pooled learners train on every day; expression models look at known days only.
    daily = one_per_day(daily.where(F.col("y").isNotNull()), keys, order)
    write(fill_gaps(daily, keys, span=span) if pooled else between_dates(daily, *(span or (None, None))), "series")
    days = read("series")

    if "backtest" not in skip:
        run = learners.backtest if pooled else bt.run
        write(run(days, backtest_models, keys, warmup, newest), "backtest")
    if "calibrate" not in skip:
        detail = read("backtest")
        write(weekday_bias(detail, keys), "bias")
        horizon = days.groupBy(*keys).agg(days_to_sunday(F.max("date")).alias("horizon"))
        write(best_switch(detail, keys, horizon), "switch")
    if "forecast" not in skip:
        wanted = {m: models[m] for m in ("iterative", "multi")}
        rows = learners.forecast(days, wanted, keys) if pooled else forecast(origins(days, keys), wanted, keys)
        biases = None if bias is not None else read("bias")
        chosen = switch if switch is not None else read("switch")
        hybrid = compose_hybrid(apply_bias(rows, biases, keys, bias), chosen, keys)
        append_predictions(hybrid, path["predictions"], run_time, keys)
    if "rollup" not in skip:
        log = spark.read.parquet(path["predictions"])
        actuals = (days.where(~F.col("is_filled")) if pooled else days).select(*keys, "date", "y")
        week = week_days(log, actuals, keys)
        write(skipped_weeks(week, keys), "weekly_skipped")
        write(weekly_numbers(week, keys, allow_partial, log), "weekly")
        numbers = read("weekly")
        write_weekly_json(numbers, f"{base}/weekly_json", run_time)
        upsert_keyed(
            summary_rows(numbers, run_time, keys), path["summary"], [*keys, "calculation_date"], "calculation_date", keep=keep_versions
        )
    return read_outputs(spark, base)


def read_outputs(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables a run has left under ``base``; those of skipped stages only if an earlier run wrote them."""
    found = {n: read_committed(spark, f"{base}/{n}") for n in TABLES}
    found["predictions"] = table_or_none(spark, f"{base}/predictions")
    found["summary"] = read_keyed(spark, f"{base}/summary")
    return {n: df for n, df in found.items() if df is not None}


def run_records(spark: SparkSession, base: str) -> DataFrame:
    """(stage, table, as_of, n_rows, n_nulls): what the newest run of each stage wrote, as counted while it wrote."""
    records = {n: committed_record(spark, f"{base}/{n}") for n in TABLES}
    rows = [(r["stage"], n, r["as_of"], r["rows"], sum(r["nulls"].values())) for n, r in records.items() if r is not None]
    return spark.createDataFrame(rows, "stage string, table string, as_of string, n_rows long, n_nulls long")


def require_output(spark: SparkSession, base: str) -> DataFrame:
    """The summary table, or an error when the run left none."""
    summary = read_keyed(spark, f"{base}/summary")
    if summary is None or summary.isEmpty():
        raise ValueError(f"no weekly summary under {base}")
    return summary


def quality_checks(
    daily: DataFrame, predictions: DataFrame, as_of: str, keys: Sequence[str] = KEYS, max_age_days: int = 7
) -> DataFrame:
    """Per series: is the newest value fresh, and are all predictions within the range seen so far."""
    history = daily.groupBy(*keys).agg(
        F.max("date").alias("newest_date"), F.min("y").alias("lowest"), F.max("y").alias("highest")
    )
    spread = predictions.groupBy(*keys).agg(
        F.min("predicted").alias("lowest_predicted"),
        F.max("predicted").alias("highest_predicted"),
        F.count("predicted").alias("n_predictions"),
    )
    age = F.date_diff(F.lit(as_of).cast("date"), "newest_date")
    return history.join(spread, [*keys], "left").select(
        *keys,
        "newest_date",
        age.alias("age_days"),
        (age <= max_age_days).alias("is_fresh"),
        F.coalesce(F.col("n_predictions"), F.lit(0)).alias("n_predictions"),
        F.coalesce(
            (F.col("lowest_predicted") >= F.col("lowest")) & (F.col("highest_predicted") <= F.col("highest")), F.lit(False)
        ).alias("in_range"),
    )
