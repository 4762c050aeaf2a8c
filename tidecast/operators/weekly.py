"""Weekly roll-up of a prediction log and actuals, per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidecast.functions.dates import iso_text, week_start, weekday
from tidecast.operators.series import KEYS, one_per_day

# Fixed values.
PREDICTED, ACTUAL = "predicted", "actual"
COMPLETE, PARTIAL = "complete_week", "partial_period"
MIXED, PREDICTIONS_ONLY = "mixed", "predictions_only"
SUMMARY_COLUMNS = (
    "period",
    "period_type",
    "data_mix",
    "num_days",
    "daily_average_ridership",
    "total_period_ridership",
    "calculation_date",
)
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def latest_predictions(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Newest non-null prediction of each target date; equal run times fall to the larger value."""
    order = F.when(F.col("predicted").isNotNull(), F.struct("predicted_at", "predicted"))
    return log.groupBy(*keys, "target_date").agg(
        F.max_by("predicted", order).alias("predicted"), F.max("predicted_at").alias("predicted_at")
    )


def _newest_week(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per series the Monday of the newest target date and a date -> prediction map of that week.

    The log is reduced to one row per series and target date first; the map has
    at most seven entries.
    """
    latest = latest_predictions(log, keys)
    newest = F.max("target_date").over(Window.partitionBy(*keys))
    return (
        latest.withColumn("week_start", week_start(newest))
        .where(F.col("target_date") >= F.col("week_start"))
        .groupBy(*keys, "week_start")
        .agg(F.map_from_entries(F.collect_list(F.struct("target_date", "predicted"))).alias("_days"))
    )


def week_days(
    log: DataFrame, actuals: DataFrame, keys: Sequence[str] = KEYS, order: str | None = None
) -> DataFrame:
    """Seven rows per series: predictions where the log has the day, else actuals, else null.

    ``has_mixed_data`` is true when any day is not in the log, found in the
    actuals or not. Only days missing from the log are matched with actuals. Of several
    actuals of a day the one with the largest ``order`` counts; without an order column a
    doubled day is an error.
    """
    date = F.date_add("week_start", F.col("_k"))
    spine = _newest_week(log, keys).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("_k")
    ).select(
        *keys,
        "week_start",
        date.alias("date"),
        F.map_contains_key("_days", date).alias("_in_log"),
        F.try_element_at("_days", date).alias("_predicted"),
        (F.size("_days") < 7).alias("has_mixed_data"),
    )
    seen = one_per_day(actuals, keys, order).select(*keys, "date", F.col("y").alias("_actual"))
    # A day of the log never meets an actual: its join date is null.
    wanted = F.when(~F.col("_in_log"), F.col("date"))
    joined = spine.withColumn("_want", wanted).join(
        seen.withColumnRenamed("date", "_want"), [*keys, "_want"], "left"
    )
    return joined.select(
        *keys,
        "week_start",
        "date",
        F.coalesce("_predicted", "_actual").alias("ridership"),
        F.when(F.col("_in_log"), F.lit(PREDICTED)).when(F.col("_actual").isNotNull(), F.lit(ACTUAL)).alias("data_type"),
        "has_mixed_data",
    )


def missing_days(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Days of each series' newest week that the log lacks."""
    return (
        _newest_week(log, keys)
        .select("*", F.explode(F.sequence("week_start", F.date_add("week_start", 6))).alias("date"))
        .where(~F.map_contains_key("_days", F.col("date")))
        .select(*keys, "date")
    )


def actuals_for(actuals: DataFrame, wanted: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Actual rows of the wanted (key, date) pairs."""
    return actuals.join(wanted.select(*keys, "date"), [*keys, "date"], "left_semi")


def half_even(value: Column) -> Column:
    """Whole number, halves to even; the last bits of a sum do not turn a half."""
    return F.bround(F.round(value, 6), 0).cast("long")


def weekly_numbers(
    days: DataFrame,
    keys: Sequence[str] = KEYS,
    allow_partial: bool = False,
    log: DataFrame | None = None,
) -> DataFrame:
    """Weekly totals and a day-name breakdown, one row per series, one aggregate.

    Incomplete weeks are dropped unless ``allow_partial``. With ``allow_partial``
    and a ``log``, a series whose week has no value at all falls back to the
    newest predictions of all its days.
    """
    rows = days.where(F.col("ridership").isNotNull()).select(
        *keys, "date", "ridership", "data_type", "has_mixed_data", F.lit(True).alias("_in_week")
    )
    if allow_partial and log is not None:
        # Every newest prediction joins in as a fallback row; a series with week rows keeps only those.
        rest = latest_predictions(log, keys).where(F.col("predicted").isNotNull())
        rows = rows.unionByName(
            rest.select(
                *keys,
                F.col("target_date").alias("date"),
                F.col("predicted").alias("ridership"),
                F.lit(PREDICTED).alias("data_type"),
                F.lit(False).alias("has_mixed_data"),
                F.lit(False).alias("_in_week"),
            )
        )
        has_week = F.max("_in_week").over(Window.partitionBy(*keys))
        rows = rows.withColumn("_has_week", has_week).where(F.col("_in_week") == F.col("_has_week")).drop("_has_week")
    numbers = rows.groupBy(*keys).agg(
        F.avg("ridership").alias("daily_average"),
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.sum("ridership").alias("total_period_ridership"),
        F.count(F.lit(1)).cast("int").alias("num_days"),
        F.bool_or("has_mixed_data").alias("has_mixed_data"),
        F.bool_and("_in_week").alias("_in_week"),
        F.min("ridership").alias("min_daily"),
        F.max("ridership").alias("max_daily"),
        *[_newest_of_weekday(k).alias(f"_{k}") for k in range(7)],
    )
    complete = (F.col("num_days") == 7) & F.col("_in_week")
    named = F.map_from_entries(
        F.filter(
            F.array(*[F.struct(F.lit(n).alias("day"), F.col(f"_{k}").alias("value")) for k, n in enumerate(DAY_NAMES)]),
            lambda e: e["value"].isNotNull(),
        )
    )
    out = numbers.select(
        *keys,
        "daily_average",
        F.concat_ws(" to ", iso_text(F.col("start_date")), iso_text(F.col("end_date"))).alias("period_description"),
        "start_date",
        "end_date",
        "total_period_ridership",
        "num_days",
        complete.alias("is_complete_week"),
        "has_mixed_data",
        "min_daily",
        "max_daily",
        named.alias("daily_breakdown"),
    )
    return out if allow_partial else out.where("is_complete_week")


def _newest_of_weekday(k: int) -> Column:
    day = F.struct("date", half_even(F.col("ridership")).alias("ridership"), "data_type")
    return F.max_by(F.when(weekday(F.col("date")) == k, day), F.when(weekday(F.col("date")) == k, F.col("date")))


def skipped_weeks(days: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, week_start, num_days, reason) of the series whose week ``weekly_numbers`` leaves out."""
    found = days.groupBy(*keys, "week_start").agg(F.count("ridership").cast("int").alias("num_days"))
    reason = F.when(F.col("num_days") == 0, "no value in the week").otherwise(
        F.concat(F.lit("only "), F.col("num_days").cast("string"), F.lit(" of 7 days"))
    )
    return found.where(F.col("num_days") < 7).withColumn("reason", reason)


def breakdown_rows(numbers: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The day-name map as rows."""
    return numbers.select(*keys, F.explode("daily_breakdown").alias("day_name", "_d")).select(*keys, "day_name", "_d.*")


def summary_rows(numbers: DataFrame, calculation_date: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """The history row of each series' week."""
    return numbers.select(
        *keys,
        F.col("period_description").alias("period"),
        F.when(F.col("is_complete_week"), COMPLETE).otherwise(PARTIAL).alias("period_type"),
        F.when(F.col("has_mixed_data"), MIXED).otherwise(PREDICTIONS_ONLY).alias("data_mix"),
        "num_days",
        half_even(F.col("daily_average")).alias("daily_average_ridership"),
        half_even(F.col("total_period_ridership")).alias("total_period_ridership"),
        calculation_date.cast("date").alias("calculation_date"),
    )


def unique_rows(rows: DataFrame, on: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: that of the largest ``order`` column; without one a doubled key fails the job."""
    rest = [c for c in rows.columns if c not in on]
    if order is None:
        text = F.concat_ws(" ", F.lit("doubled key:"), *[F.col(c).cast("string") for c in on])
        n = F.when(F.col("_n") > 1, F.raise_error(text).cast("long")).otherwise(F.col("_n"))
        one = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
        return one.withColumn("_n", n).where("_n = 1").select(*on, "_row.*").select(*rows.columns)
    newest = F.max_by(F.struct(*rest), F.struct(order, F.xxhash64(*rest)))
    return rows.groupBy(*on).agg(newest.alias("_row")).select(*on, "_row.*").select(*rows.columns)


def upsert(old: DataFrame, new: DataFrame, on: Sequence[str], order: str | None = None) -> DataFrame:
    """Rows of ``old`` whose key is not in ``new``, plus ``new``, whose keys are made unique by ``unique_rows``."""
    return replaced(old, unique_rows(new, on, order), on)


def replaced(old: DataFrame, new: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``old`` whose key is not in ``new``, plus ``new``, whose keys are unique."""
    return old.join(new.select(*on), [*on], "left_anti").unionByName(new)


def newest_sunday_week(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per series the week of the newest logged Sunday, with its count of distinct days.

    Two aggregates: log rows collapse to (series, week) with a bit per weekday,
    then to the newest week that has a Sunday.
    """
    bit = F.expr("shiftleft(1, weekday(target_date))")
    weeks = (
        log.where(F.col("target_date").isNotNull())
        .groupBy(*keys, week_start(F.col("target_date")).alias("monday"))
        .agg(F.bit_or(bit).alias("_days"))
        .where(F.col("_days").bitwiseAND(F.lit(64)) != 0)
    )
    newest = weeks.groupBy(*keys).agg(F.max("monday").alias("monday"), F.max_by("_days", "monday").alias("_days"))
    return newest.select(
        *keys, "monday", F.date_add("monday", 6).alias("sunday"), F.bit_count("_days").alias("num_days")
    )


def recent_complete_week(log: DataFrame, keys: Sequence[str] = KEYS, strict: bool = False) -> DataFrame:
    """Log rows of each series' newest Sunday week, if all seven days are there.

    An incomplete week drops the series, or fails the job with ``strict``.
    """
    weeks = newest_sunday_week(log, keys)
    if strict:
        found = F.concat(F.lit("incomplete week: "), F.col("num_days").cast("string"), F.lit(" days"))
        weeks = weeks.withColumn("num_days", F.when(F.col("num_days") == 7, F.col("num_days")).otherwise(F.raise_error(found).cast("int")))
    weeks = weeks.where(F.col("num_days") == 7).select(*keys, "monday", "sunday")
    tagged = log.withColumn("monday", week_start(F.col("target_date")))
    return tagged.join(weeks, [*keys, "monday"])

