"""Calendar covariates: weekday, month, weekend and public holidays.

Holidays are date arithmetic, so the default flag is a column expression that
needs no dimension table and no join. A table of one's own can be joined instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.dates import weekday
from tidecast.operators.series import KEYS

MON, TUE, THU = 0, 1, 3


class Rule(NamedTuple):
    name: str
    month: int
    kind: str  # "day": fixed day, "nth": nth weekday, "last": last weekday, "range": weekday in a day range
    a: int
    b: int
    since: int
    observed: bool


# Public holidays of the United States and of the state of New York.
# day: a = day of month; nth: a = weekday, b = which; last: a = weekday;
# range: a = weekday, b = first day of a seven-day range.
HOLIDAY_RULES = (
    Rule("New Year's Day", 1, "day", 1, 0, 1871, True),
    Rule("Martin Luther King Jr. Day", 1, "nth", MON, 3, 1986, False),
    Rule("Lincoln's Birthday", 2, "day", 12, 0, 1971, True),
    Rule("Susan B. Anthony Day", 2, "day", 15, 0, 2004, False),
    Rule("Washington's Birthday", 2, "nth", MON, 3, 1971, False),
    Rule("Memorial Day", 5, "last", MON, 0, 1971, False),
    Rule("Juneteenth National Independence Day", 6, "day", 19, 0, 2021, True),
    Rule("Independence Day", 7, "day", 4, 0, 1871, True),
    Rule("Labor Day", 9, "nth", MON, 1, 1894, False),
    Rule("Columbus Day", 10, "nth", MON, 2, 1971, False),
    Rule("Election Day", 11, "range", TUE, 2, 2015, False),
    Rule("Veterans Day", 11, "day", 11, 0, 1978, True),
    Rule("Thanksgiving Day", 11, "nth", THU, 4, 1942, False),
    Rule("Christmas Day", 12, "day", 25, 0, 1871, True),
)


#: The rules are those since the act that moved holidays to Mondays; before this year some had
#: other days, and flag and name are unknown.
FIRST_YEAR = 1971


def _on_rule_day(day: Column, rule: Rule) -> Column:
    dom = F.dayofmonth(day)
    here = (F.month(day) == rule.month) & (F.year(day) >= rule.since)
    if rule.kind == "day":
        return here & (dom == rule.a)
    on_weekday = here & (weekday(day) == rule.a)
    if rule.kind == "nth":
        return on_weekday & dom.between(7 * rule.b - 6, 7 * rule.b)
    if rule.kind == "last":
        return on_weekday & (F.month(F.date_add(day, 7)) != rule.month)
    return on_weekday & dom.between(rule.b, rule.b + 6)


def _observed(day: Column, rule: Rule) -> Column:
    """A holiday on a Saturday is also kept on Friday, one on a Sunday on Monday."""
    friday = (weekday(day) == 4) & _on_rule_day(F.date_add(day, 1), rule)
    monday = (weekday(day) == 0) & _on_rule_day(F.date_sub(day, 1), rule)
    return friday | monday


def holiday_name(day: Column) -> Column:
    """Name of the holiday on a date, null on other days and before ``FIRST_YEAR``."""
    named = [F.when(_on_rule_day(day, r), F.lit(r.name)) for r in HOLIDAY_RULES]
    shifted = [F.when(_observed(day, r), F.lit(f"{r.name} (observed)")) for r in HOLIDAY_RULES if r.observed]
    return F.when(F.year(day) >= FIRST_YEAR, F.coalesce(*named, *shifted))


def _first_year(years: dict[int, int], key: Column) -> Column:
    """First year of the rule with the key, null without one: a lookup in a small constant map."""
    entries = [F.lit(v) for pair in years.items() for v in pair]
    return F.try_element_at(F.create_map(*entries), key)


def is_holiday(day: Column) -> Column:
    """True on a holiday or its observed day, null before ``FIRST_YEAR``.

    Rules are looked up by month and day, or by month, weekday and week of the
    month, instead of being tried one by one: a few integer operations per row.
    """

    def month_day(d: Column) -> Column:
        return F.month(d) * 100 + F.dayofmonth(d)

    fixed = {r.month * 100 + r.a: r.since for r in HOLIDAY_RULES if r.kind == "day"}
    kept = {r.month * 100 + r.a: r.since for r in HOLIDAY_RULES if r.kind == "day" and r.observed}
    nth = {r.month * 100 + r.a * 10 + r.b: r.since for r in HOLIDAY_RULES if r.kind == "nth"}
    week = F.floor((F.dayofmonth(day) + 6) / 7).cast("int")
    on = weekday(day)
    tests = [
        _first_year(fixed, month_day(day)) <= F.year(day),
        _first_year(nth, F.month(day) * 100 + on * 10 + week) <= F.year(day),
        *[_on_rule_day(day, r) for r in HOLIDAY_RULES if r.kind in ("last", "range")],
    ]
    for shift, falls in ((1, 4), (-1, 0)):
        other = F.date_add(day, shift)
        tests.append((on == falls) & (_first_year(kept, month_day(other)) <= F.year(other)))
    return F.when(F.year(day) >= FIRST_YEAR, F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)))


def is_weekend(day: Column) -> Column:
    return weekday(day) >= 5


def holiday_table(spark: SparkSession, first_year: int, last_year: int, region: str = "US-NY") -> DataFrame:
    """``(region, date, name)`` rows of the given years."""
    days = spark.range(first_year, last_year + 1).select(
        F.explode(F.sequence(F.make_date("id", F.lit(1), F.lit(1)), F.make_date("id", F.lit(12), F.lit(31)))).alias("date")
    )
    return days.select(F.lit(region).alias("region"), "date", holiday_name(F.col("date")).alias("name")).dropna()


CALENDAR_COLUMNS = (
    *[f"dow_{k}" for k in range(7)],
    *[f"month_{k}" for k in range(1, 13)],
    "is_weekend",
    "is_holiday",
)


def calendar_values(day: Column, holiday: Column | None = None) -> list[Column]:
    """The 21 covariates of a date as 0/1 integers, in ``CALENDAR_COLUMNS`` order."""
    flags = [weekday(day) == k for k in range(7)]
    flags += [F.month(day) == k for k in range(1, 13)]
    flags += [is_weekend(day), is_holiday(day) if holiday is None else holiday]
    return [f.cast("int").alias(n) for f, n in zip(flags, CALENDAR_COLUMNS)]


def with_calendar(df: DataFrame, date: str = "date", holidays: DataFrame | None = None) -> DataFrame:
    """Add the covariates. ``holidays`` replaces the built-in rules by a table with a ``date`` column.

    The table is left to the planner's own size check; it is never force-broadcast.
    """
    if holidays is None:
        return df.select("*", *calendar_values(F.col(date)))
    listed = holidays.select(F.col("date").alias(date), F.lit(True).alias("_holiday")).distinct()
    joined = df.join(listed, date, "left")
    flag = F.coalesce("_holiday", F.lit(False))
    return joined.select(*df.columns, *calendar_values(F.col(date), flag))


def calendar_span(daily: DataFrame, days: int = 0, keys: Sequence[str] = KEYS, holidays: DataFrame | None = None) -> DataFrame:
    """Covariates of every day from a series' first date to ``days`` past its last."""
    span = daily.groupBy(*keys).agg(F.min("date").alias("_a"), F.max("date").alias("_b"))
    spine = span.select(*keys, F.explode(F.sequence("_a", F.date_add("_b", days))).alias("date"))
    return with_calendar(spine, "date", holidays)
