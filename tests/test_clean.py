import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidecast.functions import coerce, dates
from tidecast.operators.clean import clean_counts, require_rows

RAW = "date string, mode string, count string"


def test_clean_counts_filters_parses_and_drops(frame):
    raw = frame(
        RAW,
        [
            ("2024-01-01T00:00:00.000", "Subway", "10"),
            ("2024-01-02T00:00:00.000", "NYC SUBWAY lines", "20.5"),
            ("2024-01-03T00:00:00.000", "Bus", "30"),
            ("2024-01-04T00:00:00.000", None, "40"),
            ("bad", "Subway", "50"),
            ("2024-01-06", "Subway", "n/a"),
            (None, "Subway", "60"),
            ("2024-01-08", "subway", None),
        ],
    )
    got = sorted(tuple(r) for r in clean_counts(raw, mode_text="Subway").collect())
    assert got == [("subway", dt.date(2024, 1, 1), 10.0), ("subway", dt.date(2024, 1, 2), 20.5)]


def test_clean_counts_without_mode_column(frame):
    raw = frame("date string, count string", [("2024-01-01", "1")])
    assert clean_counts(raw, mode_text="Subway").count() == 1


def test_missing_columns_are_named(frame):
    with pytest.raises(KeyError, match="count"):
        clean_counts(frame("date string", [("2024-01-01",)]))


def test_empty_input_is_an_error(frame):
    with pytest.raises(ValueError, match="raw counts"):
        require_rows(frame(RAW, []), "raw counts")


@pytest.mark.parametrize(
    "text, value",
    [("1", 1.0), (" 2.5 ", 2.5), ("-3e2", -300.0), (".5", 0.5), ("1f", None), ("0x1p3", None), ("NaN", None),
     ("", None), (None, None), ("1_000", None), ("5.", 5.0), ("inf", float("inf"))],
)
def test_number_or_null(frame, text, value):
    got = frame("t string", [(text,)]).select(coerce.number_or_null(F.col("t"))).first()[0]
    assert got == value


@pytest.mark.parametrize(
    "text, value",
    [("2024-02-29", dt.date(2024, 2, 29)), ("2023-02-29", None), ("2024-03-10T23:59:59.999", dt.date(2024, 3, 10)),
     ("2024-03-10T23:59:59-05:00", dt.date(2024, 3, 10)), ("2024-03-10Tjunk", None)],
)
def test_date_or_null(frame, text, value):
    assert frame("t string", [(text,)]).select(coerce.date_or_null(F.col("t"))).first()[0] == value


def test_contains_text_is_literal(frame):
    rows = frame("t string", [("a.b",), ("axb",), (None,)])
    assert [r[0] for r in rows.select(coerce.contains_text(F.col("t"), "A.B")).collect()] == [True, False, False]


def test_days_to_sunday(frame):
    week = frame("d date", [(f"2024-01-0{i}",) for i in range(1, 8)])  # Monday to Sunday
    got = [r[0] for r in week.select(dates.days_to_sunday(F.col("d"))).collect()]
    assert got == [6, 5, 4, 3, 2, 1, 7]


def test_local_date_crosses_midnight_and_dst(frame):
    rows = frame("ts timestamp_ntz", [("2024-03-10T04:30:00",), ("2024-03-11T04:30:00",), ("2024-07-01T03:59:00",)])
    got = [r[0] for r in rows.select(dates.local_date(F.col("ts"))).collect()]
    assert got == [dt.date(2024, 3, 9), dt.date(2024, 3, 11), dt.date(2024, 6, 30)]


@pytest.mark.parametrize("text", ["202401", "2024", "2024-01", "10:30:00", "12024-01-01", "1066-10-14", "2262-01-01", "99999-01-01"])
def test_texts_that_are_no_full_date(frame, text):
    df = frame("t string", [(text,)])
    assert df.select(coerce.date_or_null(F.col("t"))).first()[0] is None
