"""Forecast models that are plain column expressions over a history array.

A history array holds the newest daily values of a series, oldest first, so
``lag k`` of the next day is the k-th element from the end.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidecast.operators.series import KEYS, TARGET_LAGS


@dataclass(frozen=True)
class HistoryModel:
    """``one_step`` scores the day after a history; ``direct`` scores a later step from the same history."""

    name: str
    one_step: Callable[[Column], Column]
    direct: Callable[[Column, Column], Column]


def seasonal_naive(period: int = 7) -> HistoryModel:
    """The value one period earlier. Steps past the period repeat it."""
    return HistoryModel(
        "seasonal_naive",
        lambda hist: F.element_at(hist, -period),
        lambda hist, step: F.element_at(hist, (step - 1) % period - period),
    )


def lag_mean(lags: Sequence[int] = TARGET_LAGS) -> HistoryModel:
    """Mean of the given lags. The direct form gives every step the origin's lags."""

    def score(hist: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.element_at(hist, -k) for k in lags]) / len(lags)

    return HistoryModel("lag_mean", score, lambda hist, step: score(hist))


def iterated_path(hist: Column, steps: Column, model: HistoryModel) -> Column:
    """Predictions of steps 1..n, each fed back as the newest value of the next."""
    grown = F.reduce(F.sequence(F.lit(1), steps), hist, lambda acc, _: F.concat(acc, F.array(model.one_step(acc))))
    return F.slice(grown, F.size(hist) + 1, steps)


def direct_path(hist: Column, steps: Column, model: HistoryModel) -> Column:
    """Predictions of steps 1..n, all from the same history."""
    return F.transform(F.sequence(F.lit(1), steps), lambda s: model.direct(hist, s))


# Days are counted from a fixed date, so that a trend line does not depend on the series' first day.
TREND_EPOCH = "2000-01-01"


def day_number(day: Column) -> Column:
    return F.date_diff(day, F.lit(TREND_EPOCH).cast("date"))


def with_running_trend(daily: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Least-squares line over all rows up to each row: a running aggregate, linear in the rows."""
    upto = Window.partitionBy(*keys).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    x = day_number(F.col("date"))
    return daily.select(
        "*",
        F.regr_slope("y", x).over(upto).alias("slope"),
        F.regr_intercept("y", x).over(upto).alias("intercept"),
    )


def trend_fit(daily: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Least-squares line of each series, partially aggregated before the shuffle."""
    x = day_number(F.col("date"))
    return daily.groupBy(*keys).agg(
        F.regr_slope("y", x).alias("slope"),
        F.regr_intercept("y", x).alias("intercept"),
        F.max("date").alias("origin"),
    )


def trend_value(day: Column) -> Column:
    return F.col("intercept") + F.col("slope") * day_number(day)


def scaled(value: Column, lo: Column, hi: Column) -> Column:
    """Min-max scale; a constant series scales to zero."""
    return F.when(hi > lo, (value - lo) / (hi - lo)).when(value.isNotNull(), F.lit(0.0))


def unscaled(value: Column, lo: Column, hi: Column) -> Column:
    return lo + value * (hi - lo)


def scale_bounds(daily: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return daily.groupBy(*keys).agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
