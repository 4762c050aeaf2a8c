"""Unit conversions of the weather inputs."""

from __future__ import annotations

from pyspark.sql import Column

# Fixed values.
MM_PER_INCH = 25.4
MPH_PER_METRE_SECOND = 2.23694


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9.0 / 5.0 + 32.0


def inches(millimetres: Column) -> Column:
    return millimetres / MM_PER_INCH


def miles_per_hour(metres_per_second: Column) -> Column:
    return metres_per_second * MPH_PER_METRE_SECOND
