"""Declared schemas of the inputs and saved tables; nothing is inferred."""

from __future__ import annotations

RAW_COUNTS = "date STRING, mode STRING, count STRING"
ACTUALS = "series_id STRING, date DATE, y DOUBLE"
HOLIDAYS = "region STRING, date DATE, name STRING"
PREDICTION_LOG = "series_id STRING, target_date DATE, predicted DOUBLE, predicted_at TIMESTAMP"
BACKTEST_DETAIL = (
    "series_id STRING, train_end DATE, mode STRING, target_date DATE, step INT, predicted DOUBLE, "
    "actual DOUBLE, error DOUBLE, abs_error DOUBLE, squared_error DOUBLE"
)
SUMMARY_HISTORY = (
    "series_id STRING, period STRING, period_type STRING, data_mix STRING, num_days INT, "
    "daily_average_ridership BIGINT, total_period_ridership BIGINT, calculation_date DATE"
)
STATION_DAYS = "station_id STRING, date DATE, tmin DOUBLE, tmax DOUBLE, prcp DOUBLE, snow DOUBLE"
HOURLY_FORECAST = (
    "struct<properties: struct<periods: array<struct<startTime: string, temperature: string, "
    "probabilityOfPrecipitation: struct<value: string>, windGust: struct<value: string>>>>>"
)
DAILY_FORECAST = (
    "struct<daily: struct<time: array<string>, temperature_2m_max: array<string>, "
    "temperature_2m_min: array<string>, precipitation_sum: array<string>, "
    "precipitation_probability_max: array<string>, wind_gusts_10m_max: array<string>>>"
)
TRADES = "trade_id BIGINT, ticker STRING, ts BIGINT"
