"""Forecast documents (JSON text per station) to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.coerce import date_or_null, instant_or_null, number_or_null
from tidecast.functions.units import fahrenheit, inches, miles_per_hour
from tidecast.sources.schemas import DAILY_FORECAST, HOURLY_FORECAST

STATION = ("station_id",)


def hourly_forecast(docs: DataFrame, body: str = "body", keys: Sequence[str] = STATION) -> DataFrame:
    """One row per hourly period: (keys, ts, temp_f, pop_pct, windgust_mph).

    Missing or null sub-objects give nulls; a period without a readable time is dropped.
    """
    parsed = docs.select(*keys, F.from_json(body, HOURLY_FORECAST).alias("_d"))
    periods = parsed.select(*keys, F.explode("_d.properties.periods").alias("_p"))
    return periods.select(
        *keys,
        instant_or_null(F.col("_p.startTime")).alias("ts"),
        number_or_null(F.col("_p.temperature")).alias("temp_f"),
        number_or_null(F.col("_p.probabilityOfPrecipitation.value")).alias("pop_pct"),
        number_or_null(F.col("_p.windGust.value")).alias("windgust_mph"),
    ).dropna(subset=["ts"])


DAILY_ARRAYS = (
    "temperature_2m_max",
    "temperature_2m_min",
    "precipitation_sum",
    "precipitation_probability_max",
    "wind_gusts_10m_max",
)


def daily_forecast(docs: DataFrame, body: str = "body", keys: Sequence[str] = STATION) -> DataFrame:
    """One row per forecast day in Fahrenheit, inches and miles per hour.

    The document holds parallel arrays. Cells are converted one by one, so a bad cell is
    null and costs nothing else; an absent or short array gives nulls. Without a ``time``
    array a document gives no rows: ``unreadable_documents`` lists it.
    """
    daily = docs.select(*keys, F.from_json(body, DAILY_FORECAST)["daily"].alias("_d")).where(F.col("_d.time").isNotNull())
    none = F.array_repeat(F.lit(None).cast("string"), F.size("_d.time"))
    zipped = daily.select(
        *keys, F.col("_d.time").alias("time"), *[F.coalesce(F.col(f"_d.{a}"), none).alias(a) for a in DAILY_ARRAYS]
    ).select(*keys, F.posexplode(F.arrays_zip("time", *DAILY_ARRAYS)).alias("_at", "_r"), F.size("time").alias("_n"))
    zipped = zipped.where(F.col("_at") < F.col("_n"))

    def cell(name: str) -> Column:
        return number_or_null(F.col(f"_r.{name}"))

    return zipped.select(
        *keys,
        date_or_null(F.col("_r.time")).alias("date"),
        fahrenheit(cell("temperature_2m_max")).alias("om_tmax_f"),
        fahrenheit(cell("temperature_2m_min")).alias("om_tmin_f"),
        inches(cell("precipitation_sum")).alias("om_prcp_in"),
        cell("precipitation_probability_max").alias("om_pop_max"),
        miles_per_hour(cell("wind_gusts_10m_max")).alias("om_windgust_mph"),
    )


def unreadable_documents(docs: DataFrame, kind: str, body: str = "body", keys: Sequence[str] = STATION) -> DataFrame:
    """(keys, body, reason) of documents that give no rows; ``kind`` is ``hourly`` or ``daily``."""
    if kind == "hourly":
        found = F.from_json(body, HOURLY_FORECAST)["properties"]["periods"]
        what = "periods"
    else:
        found = F.from_json(body, DAILY_FORECAST)["daily"]["time"]
        what = "time array"
    reason = (
        F.when(F.col(body).isNull(), "no document")
        .when(F.get_json_object(body, "$").isNull(), "not JSON")
        .when(found.isNull(), f"no {what}")
        .when(F.size(found) == 0, f"empty {what}")
    )
    return docs.select(*keys, F.col(body).alias("body"), reason.alias("reason")).where(F.col("reason").isNotNull())
