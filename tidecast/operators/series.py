"""Regular daily series: totals, gap fill, spans, cuts, lags, histories.

Raw rows are first reduced to one row per series and day by a two-phase
aggregate keyed on (series, day), so a series holding most of the raw rows is
spread over its days and combined map-side. Everything after that is windowed by
series over at most one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

KEYS = ("series_id",)

# The target lags of the forecast features.
TARGET_LAGS = (1, 2, 3, 4, 5, 6, 7, 14, 21)

#: Days in the longest gap that ``fill_gaps`` builds.
LONGEST_GAP = 3660


def by_date(keys: Sequence[str], date: str = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(date)


def daily_totals(
    df: DataFrame, value: Column, date: str = "date", keys: Sequence[str] = KEYS
) -> DataFrame:
    """One row per series and day, ``y`` the sum of ``value``."""
    return df.groupBy(*keys, F.col(date).alias("date")).agg(F.sum(value).alias("y"))


def between_dates(df: DataFrame, start: str | None = None, end: str | None = None, date: str = "date") -> DataFrame:
    """Optional closed date range; bounds the length of a later spine."""
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(date) <= F.lit(end).cast("date"))
    return df


def duplicate_day(date: Column) -> Column:
    """Fails the job that meets it."""
    return F.raise_error(F.concat(F.lit("duplicate day in series: "), date.cast("string"))).cast("double")


def one_per_day(rows: DataFrame, keys: Sequence[str] = KEYS, order: str | None = None, value: str = "y") -> DataFrame:
    """One (keys, date, value) row per key and day: the value of the largest ``order``, nulls first.

    Equal orders fall to the larger value. Without an order column a doubled day fails the job.
    """
    days = rows.groupBy(*keys, "date")
    if order is not None:
        newest = F.max(F.struct(F.col(order).alias("at"), F.col(value).alias("value")))
        return days.agg(newest.alias("_newest")).select(*keys, "date", F.col("_newest.value").alias(value))
    one = F.when(F.col("_n") > 1, duplicate_day(F.col("date"))).otherwise(F.col("_v").cast("double"))
    return days.agg(F.count(F.lit(1)).alias("_n"), F.max(value).alias("_v")).select(*keys, "date", one.alias(value))


def long_gap(first: Column, last: Column, most: int) -> Column:
    """``first``, or a failed job where more than ``most`` days would be built up to ``last``."""
    text = F.concat(F.lit("gap of more than "), F.lit(most), F.lit(" days after "), first.cast("string"))
    return F.when(F.date_diff(last, first) > most, F.raise_error(text).cast("date")).otherwise(first)


def fill_gaps(
    daily: DataFrame,
    keys: Sequence[str] = KEYS,
    on_duplicate: str = "error",
    span: tuple[str | None, str | None] | None = None,
    longest_gap: int = LONGEST_GAP,
) -> DataFrame:
    """Gap-free daily series from the first to the last date of each series.

    Interior gaps are interpolated linearly in time; leading and trailing nulls
    take the nearest known value. ``is_filled`` marks every day without an own
    value. A known day carries its whole following gap, so one exchange on the
    series key does the work and no spine is joined.

    Two rows of one day are an error raised by the running job, or are summed
    with ``on_duplicate="sum"``. ``span`` cuts the series to a closed range of dates first.
    A gap of more than ``longest_gap`` days fails the job instead of being built: it comes
    from a wrong date, not from a series.
    """
    if span is not None:
        daily = between_dates(daily, *span)
    if on_duplicate == "sum":
        daily = daily_totals(daily, F.col("y"), "date", keys)
    order, whole = by_date(keys), Window.partitionBy(*keys)
    value = F.col("y").cast("double")
    if on_duplicate == "error":
        # The check sits on the value, so the date column keeps its sort order for the later windows.
        value = F.when(F.lead("date").over(order) == F.col("date"), duplicate_day(F.col("date"))).otherwise(value)
    known = (
        daily.select(
            *keys,
            "date",
            value.alias("y"),
            F.min("date").over(whole).alias("_first"),
            F.max("date").over(whole).alias("_last"),
        )
        .where(F.col("y").isNotNull())
        .select(
            *keys,
            "date",
            "y",
            "_first",
            "_last",
            F.lead("date").over(order).alias("_next_date"),
            F.lead("y").over(order).alias("_next_y"),
            F.lag("date").over(order).alias("_prev_date"),
        )
    )
    begin = F.when(F.col("_prev_date").isNull(), F.col("_first")).otherwise(F.col("date"))
    stop = F.coalesce(F.date_sub("_next_date", 1), F.col("_last"))
    step = F.date_diff("_day", "date")
    gap = F.date_diff("_next_date", "date")
    inside = F.col("_next_date").isNotNull() & (F.col("_day") > F.col("date"))
    return known.withColumn("_day", F.explode(F.sequence(long_gap(begin, stop, longest_gap), stop))).select(
        *keys,
        F.col("_day").alias("date"),
        F.when(inside, F.col("y") + (F.col("_next_y") - F.col("y")) * step / gap)
        .otherwise(F.col("y"))
        .alias("y"),
        (F.col("_day") != F.col("date")).alias("is_filled"),
    )


def series_span(daily: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return daily.groupBy(*keys).agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def newest_keys(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` newest distinct values of a column; planned as a distributed top-n."""
    return df.select(column).distinct().orderBy(F.col(column).desc()).limit(n)


def trailing_mean(daily: DataFrame, n: int = 7, keys: Sequence[str] = KEYS, out: str = "avg_n") -> DataFrame:
    """Mean of the newest ``n`` rows, null until ``n`` values are there."""
    frame = by_date(keys).rowsBetween(-(n - 1), 0)
    return daily.withColumn(out, F.when(F.count("y").over(frame) == n, F.avg("y").over(frame)))


def with_lags(
    daily: DataFrame, lags: Sequence[int] = TARGET_LAGS, keys: Sequence[str] = KEYS, prefix: str = "lag_"
) -> DataFrame:
    order = by_date(keys)
    return daily.select("*", *[F.lag("y", k).over(order).alias(f"{prefix}{k}") for k in lags])


def daily_values(past: Column, length: int) -> Column:
    """The newest ``length`` daily values of an array of known (date, y), oldest first, gaps interpolated.

    The array ends at the day wanted last. Each neighbouring pair gives the days
    from its first to just before its second; pairs older than needed are left
    out and long gaps give only their newest days. A history that does not reach
    back far enough gives an empty array.
    """
    end = F.element_at(past, -1)
    pairs = F.zip_with(
        F.slice(past, 1, F.size(past) - 1),
        F.slice(past, 2, F.size(past) - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    near = F.filter(pairs, lambda p: p["b"]["date"] > F.date_sub(end["date"], length - 1))

    def between(p: Column) -> Column:
        days_apart = F.date_diff(p["b"]["date"], p["a"]["date"])
        gap = F.when(days_apart > 0, days_apart).otherwise(duplicate_day(p["a"]["date"]).cast("int"))
        first = F.greatest(F.lit(0), gap - length)
        return F.transform(
            F.sequence(first, gap - 1),
            lambda j: F.when(j == 0, p["a"]["y"]).otherwise(p["a"]["y"] + (p["b"]["y"] - p["a"]["y"]) * j / gap),
        )

    days = F.concat(F.flatten(F.transform(near, between)), F.array(end["y"]))
    return F.slice(days, -length, length)


def newest_history(daily: DataFrame, length: int = max(TARGET_LAGS), keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per series: ``origin`` (newest date) and ``hist``, its newest ``length`` daily values, oldest first.

    Works on known days only: ``length`` known days always reach back ``length``
    days, so older rows are cut by rank before anything is collected and no
    series is filled in full. A series that is too short has an empty ``hist``.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    return (
        daily.where(F.col("y").isNotNull())
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= length)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("date", "y"))).alias("_past"))
        .select(*keys, F.element_at("_past", -1)["date"].alias("origin"), daily_values(F.col("_past"), length).alias("hist"))
    )
