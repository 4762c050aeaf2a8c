import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidecast.operators import calendar as cal
from tidecast.operators import models, series


def values(df):
    return {(r["series_id"], r["date"].isoformat()): r["y"] for r in df.collect()}


def test_linear_series_is_restored(daily):
    filled = series.fill_gaps(daily(40, value=lambda i: 5.0 + 2 * i, missing={3, 4, 5, 20, 38}))
    rows = filled.orderBy("date").collect()
    assert [r["y"] for r in rows] == pytest.approx([5.0 + 2 * i for i in range(40)])
    assert sum(r["is_filled"] for r in rows) == 5


def test_fill_keeps_observed_values_and_length(daily):
    seen = daily(60, missing=set(range(10, 30)) | {45})
    filled = series.fill_gaps(seen)
    got = values(filled)
    assert len(got) == 60
    assert all(got[k] == v for k, v in values(seen).items())


def test_ends_take_the_nearest_value(frame):
    rows = [("a", "2024-01-01", None), ("a", "2024-01-03", 4.0), ("a", "2024-01-05", 8.0), ("a", "2024-01-07", None)]
    got = values(series.fill_gaps(frame("series_id string, date date, y double", rows)))
    assert [got[("a", f"2024-01-0{d}")] for d in range(1, 8)] == [4.0, 4.0, 4.0, 6.0, 8.0, 8.0, 8.0]


def test_duplicate_day_is_an_error_or_summed(frame):
    rows = frame("series_id string, date date, y double", [("a", "2024-01-01", 1), ("a", "2024-01-01", 2), ("b", "2024-01-01", 7)])
    with pytest.raises(PySparkException, match="duplicate day"):
        series.fill_gaps(rows).collect()
    assert values(series.fill_gaps(rows, on_duplicate="sum")) == {("a", "2024-01-01"): 3.0, ("b", "2024-01-01"): 7.0}


def test_fill_uses_one_exchange(daily):
    plan = series.fill_gaps(daily(10))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_trailing_mean_needs_a_full_window(daily):
    rows = series.trailing_mean(daily(9, value=float), out="m").orderBy("date").collect()
    assert [r["m"] for r in rows] == [None] * 6 + [3.0, 4.0, 5.0]


def test_daily_values_equal_the_filled_series(daily):
    seen = daily(70, missing={0, 1, 41, 42, 43, 50, 60, 61, 62, 63, 64, 65}, value=lambda i: float((i * 37) % 101))
    filled = [r["y"] for r in series.fill_gaps(seen).orderBy("date").collect()]
    row = series.newest_history(seen, 21).first()
    assert row["hist"] == pytest.approx(filled[-21:])
    assert row["origin"] == dt.date(2024, 3, 10)


def test_short_history_is_empty(daily):
    assert series.newest_history(daily(20), 21).first()["hist"] == []
    assert len(series.newest_history(daily(21), 21).first()["hist"]) == 21


def test_history_reaches_over_a_long_gap(daily):
    row = series.newest_history(daily(100, missing=set(range(1, 99)), value=float), 21).first()
    assert row["hist"] == pytest.approx([float(i) for i in range(79, 100)])


def test_span_and_newest_keys(daily):
    both = daily(5).unionByName(daily(3, series="b"))
    spans = {r["series_id"]: (r["first_date"].day, r["last_date"].day, r["n_rows"]) for r in series.series_span(both).collect()}
    assert spans == {"a": (1, 5, 5), "b": (1, 3, 3)}
    assert sorted(r[0].day for r in series.newest_keys(both, "date", 2).collect()) == [4, 5]


# Holidays of 2021 and 2022 by the public calendar.
KNOWN = {
    "2021-01-01": "New Year's Day",
    "2021-01-18": "Martin Luther King Jr. Day",
    "2021-02-12": "Lincoln's Birthday",
    "2021-02-15": "Susan B. Anthony Day",
    "2021-05-31": "Memorial Day",
    "2021-06-18": "Juneteenth National Independence Day (observed)",
    "2021-06-19": "Juneteenth National Independence Day",
    "2021-07-04": "Independence Day",
    "2021-07-05": "Independence Day (observed)",
    "2021-09-06": "Labor Day",
    "2021-10-11": "Columbus Day",
    "2021-11-02": "Election Day",
    "2021-11-11": "Veterans Day",
    "2021-11-25": "Thanksgiving Day",
    "2021-12-24": "Christmas Day (observed)",
    "2021-12-25": "Christmas Day",
    "2021-12-31": "New Year's Day (observed)",
    "2022-01-01": "New Year's Day",
    "2022-02-21": "Washington's Birthday",
}


def test_holidays(spark):
    got = {r["date"].isoformat(): r["name"] for r in cal.holiday_table(spark, 2021, 2022).collect()}
    for day, name in KNOWN.items():
        assert got[day] == name
    assert sum(d.startswith("2021") for d in got) == 17


def test_calendar_columns(daily):
    row = cal.with_calendar(daily(1, "2024-07-04")).first()
    assert [row[f"dow_{k}"] for k in range(7)] == [0, 0, 0, 1, 0, 0, 0]
    assert sum(row[f"month_{k}"] for k in range(1, 13)) == row["month_7"] == 1
    assert (row["is_weekend"], row["is_holiday"]) == (0, 1)


def test_own_holiday_table(frame, daily):
    own = frame("region string, date date, name string", [("X", "2024-01-02", "own"), ("Y", "2024-01-02", "twice")])
    rows = cal.with_calendar(daily(3), holidays=own).orderBy("date").collect()
    assert [r["is_holiday"] for r in rows] == [0, 1, 0]


def test_calendar_span_extends(daily):
    assert cal.calendar_span(daily(10, missing={4}), 7).count() == 17


def test_scale_of_a_constant_series(frame):
    rows = frame("y double, lo double, hi double", [(3, 3, 3), (4, 2, 6), (None, 2, 6)])
    got = [r[0] for r in rows.select(models.scaled(F.col("y"), F.col("lo"), F.col("hi"))).collect()]
    assert got == [0.0, 0.5, None]


def test_duplicate_days_fail_a_history_too(daily):
    twice = daily(30).unionByName(daily(1, "2024-01-28"))
    with pytest.raises(PySparkException, match="duplicate day"):
        series.newest_history(twice, 21).collect()


def test_fill_sorts_once(daily):
    plan = series.fill_gaps(daily(10))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1


def test_holiday_flag_and_name_agree(spark):
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit("1960-01-01").cast("date"), F.lit("2040-12-31").cast("date"))).alias("d")
    )
    odd = days.where(cal.is_holiday(F.col("d")) != cal.holiday_name(F.col("d")).isNotNull())
    assert odd.count() == 0


def test_long_gap_fails_and_span_cuts(frame):
    rows = frame("series_id string, date date, y double", [("a", "2024-01-01", 1), ("a", "2024-01-03", 3), ("a", "2199-01-01", 9)])
    with pytest.raises(Exception, match="gap of more than 3660 days after 2024-01-03"):
        series.fill_gaps(rows).collect()
    assert series.fill_gaps(rows, span=(None, "2030-01-01")).count() == 3
    assert series.fill_gaps(rows, longest_gap=100_000).count() > 60_000


def test_one_per_day(frame):
    rows = frame("series_id string, date date, y double, at int", [("a", "2024-01-01", 1, 1), ("a", "2024-01-01", 7, 2), ("a", "2024-01-02", 3, 1)])
    assert sorted(r["y"] for r in series.one_per_day(rows, order="at").collect()) == [3, 7]
    with pytest.raises(Exception, match="duplicate day"):
        series.one_per_day(rows).collect()


# Known dates, typed from a wall calendar and not from the rules.
TYPED = {
    2024: "01-01 01-15 02-12 02-15 02-19 05-27 06-19 07-04 09-02 10-14 11-05 11-11 11-28 12-25",
    2023: "01-01 01-02 01-16 02-12 02-13 02-15 02-20 05-29 06-19 07-04 09-04 10-09 11-07 11-10 11-11 11-23 12-25",
}


@pytest.mark.parametrize("year", sorted(TYPED))
def test_holidays_of_known_years(spark, year):
    days = spark.sql(f"SELECT explode(sequence(DATE '{year}-01-01', DATE '{year}-12-31')) AS date")
    got = {r["date"].strftime("%m-%d") for r in days.where(cal.is_holiday(F.col("date")).cast("boolean")).collect()}
    assert got == set(TYPED[year].split())


def test_holidays_are_unknown_before_the_rules(spark):
    rows = spark.sql("SELECT explode(array(DATE '1970-12-25', DATE '1971-12-25', DATE '1971-12-26')) AS date")
    assert [r[0] for r in rows.select(cal.is_holiday(F.col("date"))).collect()] == [None, True, False]
