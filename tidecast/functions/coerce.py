"""Text to typed values; anything malformed becomes null instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal or exponent notation, or an infinity. The JVM parser alone would
# also take "1f", "1d" and hexadecimal floats, which are not numbers in a CSV.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?)\s*$"


def number_or_null(value: Column) -> Column:
    """Double, or null for bad text, NaN and null."""
    text = value.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


# A full date with a four-digit year, alone or before a time. The JVM parser alone would
# also take a bare year, a year and month, a time, and years of up to six digits.
FULL_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}([T ].*)?\s*$"
FIRST_DATE, LAST_DATE = "1700-01-01", "2261-12-31"


def date_or_null(value: Column) -> Column:
    """Calendar date of an ISO date or timestamp text, independent of the session zone.

    Null for any other text and for dates outside ``FIRST_DATE`` to ``LAST_DATE``.
    """
    text = value.cast("string")
    day = F.when(text.rlike(FULL_DATE), text.try_cast("timestamp_ntz").cast("date"))
    return F.when(day.between(F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date")), day)


def instant_or_null(value: Column) -> Column:
    """Instant of an ISO text with a zone offset, or null."""
    return value.cast("string").try_cast("timestamp")


def contains_text(value: Column, needle: str) -> Column:
    """Case-insensitive literal substring test; null counts as no match."""
    return F.coalesce(F.contains(F.lower(value.cast("string")), F.lit(needle.lower())), F.lit(False))


def null_as_zero(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def column_or(columns: list[str], name: str, default: Column) -> Column:
    """The named column, or ``default`` when the frame does not have it."""
    return F.col(name) if name in columns else default


def iso_prefix(value: Column) -> Column:
    """``YYYY-MM-DD`` part of an ISO text."""
    return F.substring(value.cast("string"), 1, 10)
