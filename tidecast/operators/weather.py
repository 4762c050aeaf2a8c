"""Weather feature frames: lags, rolling statistics, streaks, season, next-day targets, scoring rows.

All windows share one partitioning and order (station, date), so a frame costs a
single exchange of daily rows, streaks included.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidecast.functions.coerce import column_or, null_as_zero
from tidecast.functions.dates import local_date
from tidecast.functions.units import fahrenheit, inches

STATION = ("station_id",)

# The columns, lags and windows of the feature frame.
MEASURES = ("tmax_f", "tmin_f", "prcp_in")
LAGS = (1, 2, 3, 7, 14)
WINDOWS = (3, 7, 14)
DAYS_IN_SEASON = 366.0
SEASON = ("doy_sin", "doy_cos", "month")
STREAKS = ("wet_streak", "dry_streak")
TARGETS = ("y_tmax_f", "y_tmin_f", "y_rain_yn")
RAW = ("tmax_f", "tmin_f", "prcp_in", "snow_in")
WINDOW_FEATURES = tuple(
    f"{m}_{suffix}"
    for m in MEASURES
    for suffix in (*[f"l{k}" for k in LAGS], *[f"{s}{n}" for n in WINDOWS for s in ("ma", "std")])
)
FEATURES = (*WINDOW_FEATURES, *SEASON, *STREAKS)
REACH = max(*LAGS, *[n - 1 for n in WINDOWS])  # the oldest row a feature reads


def observations(raw: DataFrame, start: str | None = None, end: str | None = None, keys: Sequence[str] = STATION) -> DataFrame:
    """Station days in Celsius and millimetres to Fahrenheit and inches; missing rain or snow is zero.

    The date range is applied to the scan. Dates are the station's local dates.
    """
    if start is not None:
        raw = raw.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        raw = raw.where(F.col("date") <= F.lit(end).cast("date"))
    snow = column_or(raw.columns, "snow", F.lit(None).cast("double"))
    return raw.select(
        *keys,
        "date",
        fahrenheit(F.col("tmax")).alias("tmax_f"),
        fahrenheit(F.col("tmin")).alias("tmin_f"),
        inches(null_as_zero(F.col("prcp"))).alias("prcp_in"),
        inches(null_as_zero(snow)).alias("snow_in"),
    )


def season_columns(day: Column) -> list[Column]:
    angle = F.lit(2 * math.pi) * F.dayofyear(day) / F.lit(DAYS_IN_SEASON)
    return [F.sin(angle).alias("doy_sin"), F.cos(angle).alias("doy_cos"), F.month(day).alias("month")]


def with_lags_and_rolling(df: DataFrame, keys: Sequence[str] = STATION) -> DataFrame:
    """Row lags, and mean and sample deviation over full windows that include the current row; days where ``regular_days`` came before.

    A rolling value is arithmetic over lags, so a missing or null row makes it
    null, and each window is one pass of offset reads. The sums run over
    differences to the current row, shared by the growing windows: the row is in
    every window, so that loses no precision. One measure at a time keeps the
    generated code of a stage small enough to be compiled to machine code.
    """
    order = Window.partitionBy(*keys).orderBy("date")
    for m in MEASURES:
        apart = df.select("*", *[(F.lag(m, k).over(order) - F.col(m)).alias(f"_{k}") for k in range(1, REACH + 1)])
        sums = []
        for before, n in zip((1, *WINDOWS), WINDOWS):
            added = [F.col(f"_{k}") for k in range(before, n)]
            sums.append(reduce(add, added).alias(f"_e{n}"))
            sums.append(reduce(add, [d * d for d in added]).alias(f"_q{n}"))
        lags = [F.lag(m, k).over(order).alias(f"{m}_l{k}") for k in LAGS]
        out = []
        for i, n in enumerate(WINDOWS):
            e = reduce(add, [F.col(f"_e{w}") for w in WINDOWS[: i + 1]])
            q = reduce(add, [F.col(f"_q{w}") for w in WINDOWS[: i + 1]])
            spread = F.greatest(q - e * e / n, F.lit(0.0))
            out.append((F.col(m) + e / n).alias(f"{m}_ma{n}"))
            out.append(F.when(e.isNotNull(), F.sqrt(spread / (n - 1))).alias(f"{m}_std{n}"))
        named = [f"{m}_l{k}" for k in LAGS]
        df = apart.select(*df.columns, *lags, *sums).select(*df.columns, *named, *out)
    return df


def streak(holds: Column, keys: Sequence[str] = STATION) -> Column:
    """Length of the current run of days where ``holds`` is true, 0 elsewhere.

    Reads the row number ``_row`` of ``with_row``: row number minus the row number of the last
    row that broke the run, or of the last one before a missing day; null counts as not holding.
    Running windows only, so there is no second exchange for run ids.
    """
    order = Window.partitionBy(*keys).orderBy("date")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    broken = F.when(~F.coalesce(holds, F.lit(False)), F.col("_row")).when(F.col("_apart"), F.col("_row") - 1)
    return (F.col("_row") - F.coalesce(F.max(broken).over(running), F.lit(0))).cast("int")


def with_row(df: DataFrame, keys: Sequence[str] = STATION) -> DataFrame:
    """Add ``_row``, the row's number, and ``_apart``: the day before is missing."""
    order = Window.partitionBy(*keys).orderBy("date")
    apart = F.date_diff("date", F.lag("date").over(order)) > 1
    return df.withColumns({"_row": F.row_number().over(order), "_apart": F.coalesce(apart, F.lit(False))})


def streaks(df: DataFrame, rain: str = "prcp_in", keys: Sequence[str] = STATION) -> DataFrame:
    """Add ``wet_streak`` (rain > 0) and ``dry_streak`` (all other days, null rain included); a missing day ends both."""
    wet = F.coalesce(F.col(rain) > 0, F.lit(False))
    return (
        with_row(df, keys)
        .select("*", streak(wet, keys).alias("wet_streak"), streak(~wet, keys).alias("dry_streak"))
        .drop("_row", "_apart")
    )


def regular_days(df: DataFrame, keys: Sequence[str] = STATION) -> DataFrame:
    """Add the missing days after each row, their measures null, and ``_observed``.

    Windows over rows are windows over days then. No window reaches further than ``REACH`` rows
    back, so a gap gets one more than that at most, however long it is.
    """
    gap = F.date_diff(F.lead("date").over(Window.partitionBy(*keys).orderBy("date")), "date") - 1
    more = F.least(F.greatest(F.coalesce(gap, F.lit(0)), F.lit(0)), F.lit(REACH + 1)).alias("_more")
    days = df.select("*", more).select(*df.columns, F.explode(F.sequence(F.lit(0), "_more")).alias("_k"))
    own = F.col("_k") == 0
    rest = [F.when(own, F.col(c)).alias(c) if c in MEASURES else F.col(c) for c in df.columns if c not in (*keys, "date")]
    return days.select(*keys, F.date_add("date", F.col("_k")).alias("date"), *rest, own.alias("_observed"))


def next_row(keys: Sequence[str] = STATION) -> Column:
    return F.lead(F.struct("date", *MEASURES)).over(Window.partitionBy(*keys).orderBy("date"))


def target_columns(following: str = "_next") -> list[Column]:
    """Values of the next day; null where the next row is of a later day. Unknown rain counts as no rain."""
    is_next = F.col(f"{following}.date") == F.date_add("date", 1)
    rain = F.coalesce(F.col(f"{following}.prcp_in") > 0, F.lit(False)).cast("int")
    return [
        F.date_add("date", 1).alias("target_date"),
        F.when(is_next, F.col(f"{following}.tmax_f")).alias("y_tmax_f"),
        F.when(is_next, F.col(f"{following}.tmin_f")).alias("y_tmin_f"),
        F.when(is_next, rain).alias("y_rain_yn"),
    ]


def has_all_features() -> Column:
    """True where no feature is null: the row and all rows the longest lag reaches have every measure."""
    return (F.col("_known") == REACH + 1) & F.col("snow_in").isNotNull()


def with_features(obs: DataFrame, keys: Sequence[str] = STATION) -> DataFrame:
    """Features and targets, with ``_known``, the complete days among the current and the ones a lag reaches."""
    order = Window.partitionBy(*keys).orderBy("date")
    complete = reduce(lambda a, b: a & b, [F.col(m).isNotNull() for m in MEASURES])
    known = F.count_if(complete).over(order.rowsBetween(-REACH, 0))
    rows = regular_days(streaks(obs, "prcp_in", keys).select("*", next_row(keys).alias("_next")), keys)
    wide = with_lags_and_rolling(rows.select("*", known.alias("_known")), keys).where("_observed").drop("_observed")
    return wide.select("*", *season_columns(F.col("date")), *target_columns())


def training_frame(obs: DataFrame, keys: Sequence[str] = STATION) -> DataFrame:
    """38 features, 3 targets and the raw measures per (station, target date); rows with a null drop out.

    Lags, windows and streaks count days: a row whose reach holds a missing day drops out, and so
    does the last one before a missing day.
    """
    known_next = F.col("y_tmax_f").isNotNull() & F.col("y_tmin_f").isNotNull()
    return with_features(obs, keys).where(has_all_features() & known_next).select(
        *keys, "target_date", *FEATURES, *TARGETS, *RAW
    )


def hourly_to_day(hourly: DataFrame, zone: str, keys: Sequence[str] = STATION) -> DataFrame:
    """Local-day extremes of an hourly forecast: (station, date, nws_tmax_f, nws_tmin_f, nws_pop_max, nws_windgust_max).

    ``hourly`` has (keys, ts, temp_f, pop_pct, windgust_mph) with ``ts`` a true instant.
    """
    day = local_date(F.col("ts"), zone, None)
    return hourly.groupBy(*keys, day.alias("date")).agg(
        F.max("temp_f").alias("nws_tmax_f"),
        F.min("temp_f").alias("nws_tmin_f"),
        F.max("pop_pct").alias("nws_pop_max"),
        F.max("windgust_mph").alias("nws_windgust_max"),
    )


NWS_COLUMNS = ("nws_tmax_f", "nws_tmin_f", "nws_pop_max", "nws_windgust_max")
OM_COLUMNS = ("om_tmax_f", "om_tmin_f", "om_prcp_in", "om_pop_max", "om_windgust_mph")


def newest_features(obs: DataFrame, keys: Sequence[str] = STATION) -> DataFrame:
    """The features of each station's newest row whose reach is complete and has no missing day.

    Streaks and completeness are windows over the run of days; the other features are
    computed once a station, from the ``REACH`` + 1 rows that they reach.
    """
    order = Window.partitionBy(*keys).orderBy("date")
    complete = reduce(lambda a, b: a & b, [F.col(m).isNotNull() for m in MEASURES])
    known = F.count_if(complete).over(order.rowsBetween(-REACH, 0))
    rows = streaks(obs, "prcp_in", keys).select("*", F.row_number().over(order).alias("_row"), known.alias("_known"))
    rows = rows.withColumn("_whole", has_all_features() & (F.date_diff("date", F.lag("date", REACH).over(order)) == REACH))
    newest = F.max(F.when(F.col("_whole"), F.col("_row"))).over(Window.partitionBy(*keys))
    near = rows.withColumn("_newest", newest).where(F.col("_row").between(F.col("_newest") - REACH, F.col("_newest")))
    fields = ["date", *RAW, *STREAKS]
    past = near.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_past"))
    here = past.select(*keys, "_past", F.element_at("_past", -1).alias("_now")).select(*keys, "_past", "_now.*")
    features = []
    for m in MEASURES:
        apart = [F.element_at("_past", -1 - k)[m] - F.col(m) for k in range(1, REACH + 1)]
        features += [F.element_at("_past", -1 - k)[m].alias(f"{m}_l{k}") for k in LAGS]
        for n in WINDOWS:
            e = reduce(add, apart[: n - 1])
            q = reduce(add, [d * d for d in apart[: n - 1]])
            features.append((F.col(m) + e / n).alias(f"{m}_ma{n}"))
            features.append(F.sqrt(F.greatest(q - e * e / n, F.lit(0.0)) / (n - 1)).alias(f"{m}_std{n}"))
    return here.select(*keys, *fields, *features, *season_columns(F.col("date")))


def scoring_frame(
    obs: DataFrame,
    hourly_days: DataFrame | None,
    daily_days: DataFrame | None,
    today: Column,
    keys: Sequence[str] = STATION,
) -> DataFrame:
    """Per station the newest observed features up to ``today``, dated tomorrow, with tomorrow's forecasts.

    Forecast columns are always there and null where a source has no row.
    """
    picked = newest_features(obs.where(F.col("date") <= today), keys)
    out = picked.select(*keys, F.date_add(today, 1).alias("target_date"), *FEATURES, *RAW)
    for source, columns in ((hourly_days, NWS_COLUMNS), (daily_days, OM_COLUMNS)):
        if source is None:
            out = out.select("*", *[F.lit(None).cast("double").alias(c) for c in columns])
        else:
            next_day = source.where(F.col("date") == F.date_add(today, 1)).select(*keys, *columns)
            out = out.join(next_day, [*keys], "left")
    return out
