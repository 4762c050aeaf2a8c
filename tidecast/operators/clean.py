"""Raw count rows to typed (series, date, y) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.coerce import contains_text, date_or_null, number_or_null
from tidecast.operators.series import between_dates


def require_columns(df: DataFrame, needed: Sequence[str]) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise KeyError(f"missing required columns: {missing}")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Job-edge check; reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def clean_counts(
    df: DataFrame,
    *,
    series_id: Column | None = None,
    mode_text: str | None = None,
    mode: str = "mode",
    date: str = "date",
    value: str = "count",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Keep rows whose mode contains ``mode_text``, parse date and value, drop malformed rows.

    The mode filter is skipped when the frame has no mode column. Rows come out
    unordered: a sort belongs to the sink that needs it. ``start`` and ``end`` are an
    optional closed span of dates.
    """
    require_columns(df, [date, value])
    if mode_text is not None and mode in df.columns:
        df = df.where(contains_text(F.col(mode), mode_text))
    if series_id is None:
        series_id = F.lit((mode_text or "all").lower())
    rows = df.select(
        series_id.alias("series_id"),
        date_or_null(F.col(date)).alias("date"),
        number_or_null(F.col(value)).alias("y"),
    ).dropna(subset=["date", "y"])
    return between_dates(rows, start, end)
