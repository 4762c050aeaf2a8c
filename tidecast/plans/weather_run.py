"""The weather job: observations, training frame and tomorrow's scoring rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators.weather import STATION, hourly_to_day, observations, scoring_frame, training_frame
from tidecast.sources.feeds import daily_forecast, hourly_forecast, unreadable_documents
from tidecast.sources.sinks import overwrite_table


def weather_run(
    spark: SparkSession,
    station_days: DataFrame,
    base: str,
    today: str,
    zone: str,
    hourly_docs: DataFrame | None = None,
    daily_docs: DataFrame | None = None,
    keys: Sequence[str] = STATION,
) -> dict[str, DataFrame]:
    """Write observations, training frame and scoring frame under ``base`` and return them.

    Forecast documents that give no rows are kept in the table ``unreadable``.
    """
    overwrite_table(observations(station_days, keys=keys), f"{base}/observations")
    obs = spark.read.parquet(f"{base}/observations")
    overwrite_table(training_frame(obs, keys), f"{base}/training")
    hourly = None if hourly_docs is None else hourly_to_day(hourly_forecast(hourly_docs, keys=keys), zone, keys)
    daily = None if daily_docs is None else daily_forecast(daily_docs, keys=keys)
    day = F.lit(today).cast("date")
    overwrite_table(scoring_frame(obs, hourly, daily, day, keys), f"{base}/scoring")
    names = ["observations", "training", "scoring"]
    given = {k: d for k, d in (("hourly", hourly_docs), ("daily", daily_docs)) if d is not None}
    if given:
        bad = [unreadable_documents(d, k, keys=keys).withColumn("kind", F.lit(k)) for k, d in given.items()]
        overwrite_table(reduce(DataFrame.unionByName, bad), f"{base}/unreadable")
        names.append("unreadable")
    return {n: spark.read.parquet(f"{base}/{n}") for n in names}
