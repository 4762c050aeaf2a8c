"""Forecasts from each series' newest day to the coming Sunday, and their composition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.dates import days_to_sunday
from tidecast.operators.models import HistoryModel, direct_path, iterated_path, trend_fit, trend_value
from tidecast.operators.series import KEYS, TARGET_LAGS, newest_history

HISTORY = max(TARGET_LAGS)
MODES = ("single", "multi", "iterative")


def horizons(daily: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return daily.groupBy(*keys).agg(F.max("date").alias("origin")).withColumn("horizon", days_to_sunday(F.col("origin")))


def origins(daily: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per series with ``origin``, ``hist`` and ``horizon``; short series are left out.

    ``daily`` holds the known days; filled ones may be there too.
    """
    return (
        newest_history(daily, HISTORY, keys)
        .where(F.size("hist") == HISTORY)
        .withColumn("horizon", days_to_sunday(F.col("origin")))
    )


def path_rows(frame: DataFrame, path: Column, keep: Sequence[str]) -> DataFrame:
    """Rows (keep, step, target_date, predicted) of a path of predictions."""
    return frame.select(*keep, F.posexplode(path).alias("_pos", "predicted")).select(
        *keep,
        (F.col("_pos") + 1).alias("step"),
        F.date_add("origin", F.col("_pos") + 1).alias("target_date"),
        "predicted",
    )


def mode_path(mode: str, model: HistoryModel, steps: Column) -> Column:
    hist = F.col("hist")
    if mode == "single":
        return F.array(model.one_step(hist))
    return iterated_path(hist, steps, model) if mode == "iterative" else direct_path(hist, steps, model)


def forecast(
    origin_rows: DataFrame, models: dict[str, HistoryModel], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Forecast rows of every mode in one pass over the origins.

    ``models`` maps a mode (single, multi, iterative) to its model. The modes are
    an array per origin, so the origins are read once and not unioned per mode.
    """
    steps = F.col("horizon")
    runs = F.array(
        *[F.struct(F.lit(mode).alias("mode"), mode_path(mode, m, steps).alias("path")) for mode, m in models.items()]
    )
    flat = origin_rows.select(*keys, "origin", F.explode(runs).alias("_run")).select(
        *keys, "origin", "_run.mode", F.col("_run.path").alias("_path")
    )
    return path_rows(flat, F.col("_path"), [*keys, "origin", "mode"])


def forecast_trend(filled: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Trend-line forecast of every day to the coming Sunday."""
    fits = trend_fit(filled, keys).where(F.col("slope").isNotNull())
    steps = fits.select("*", F.explode(F.sequence(F.lit(1), days_to_sunday(F.col("origin")))).alias("step"))
    target = F.date_add("origin", F.col("step"))
    return steps.select(*keys, "origin", "step", target.alias("target_date"), trend_value(target).alias("predicted"))


def holdout_last_day(daily: DataFrame, model: HistoryModel, keys: Sequence[str] = KEYS) -> DataFrame:
    """Hide each series' last day, forecast it from the rest, and score it."""
    newest = newest_history(daily, HISTORY + 1, keys).where(F.size("hist") == HISTORY + 1)
    actual = F.element_at("hist", -1)
    return newest.select(
        *keys,
        F.col("origin").alias("target_date"),
        model.one_step(F.slice("hist", 1, HISTORY)).alias("predicted"),
        actual.alias("actual"),
    ).select(
        "*",
        F.abs(F.col("predicted") - F.col("actual")).alias("abs_error"),
        (F.try_divide(F.abs(F.col("predicted") - F.col("actual")), F.col("actual")) * 100.0).alias("pct_error"),
    )


def clamp_switch(switch: Column, horizon: Column) -> Column:
    return F.greatest(F.lit(1), F.least(switch, horizon))


def compose_hybrid(rows: DataFrame, switch: int | DataFrame | None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Iterative prediction up to the switch step, direct after it, from forecast rows of both modes.

    A series without direct predictions takes the iterative ones throughout.
    ``switch`` is a number (clamped to 1..horizon), or a frame (keys, switch); a
    series absent from it, and ``None``, use half the horizon. The modes meet in one
    aggregate over the rows, which are read once.
    """
    on = [*keys, "origin", "step"]

    def of(mode: str) -> Column:
        return F.max(F.when(F.col("mode") == mode, F.col("predicted")))

    both = (
        rows.where(F.col("mode").isin("iterative", "multi"))
        .groupBy(*on)
        .agg(of("iterative").alias("_it"), of("multi").alias("_mu"), F.max("target_date").alias("target_date"))
        .where(F.col("_it").isNotNull())
    )
    horizon = days_to_sunday(F.col("origin"))
    middle = F.greatest(F.lit(1), F.floor(horizon / 2).cast("int"))
    if isinstance(switch, DataFrame):
        both = both.join(switch.select(*keys, F.col("switch").alias("_s")), [*keys], "left")
        chosen = F.coalesce(F.col("_s"), middle)
    elif switch is None:
        chosen = middle
    else:
        chosen = clamp_switch(F.lit(switch), horizon)
    both = both.withColumn("switch", chosen.cast("int"))
    return both.select(
        *on,
        "target_date",
        "switch",
        F.when(F.col("step") <= F.col("switch"), F.col("_it")).otherwise(F.coalesce("_mu", "_it")).alias("predicted"),
    )


def latest_at_or_before(frame: DataFrame, date: str, day: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per key the newest row dated at or before ``day``; partially aggregated, no sort."""
    rest = [c for c in frame.columns if c not in keys]
    return (
        frame.where(F.col(date) <= day)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col(date)).alias("_row"))
        .select(*keys, "_row.*")
    )

