import datetime as dt
import json
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import weather
from tidecast.plans.weather_run import weather_run
from tidecast.sources import feeds
from tidecast.sources.schemas import STATION_DAYS


@pytest.fixture(scope="module")
def stations(frame):
    rng = np.random.default_rng(5)
    rows = []
    for station in ("s1", "s2"):
        for i in range(40):
            day = (dt.date(2024, 2, 1) + dt.timedelta(days=i)).isoformat()
            low = float(rng.normal(0, 5))
            rain = None if i % 11 == 0 else float(max(0.0, rng.normal(0, 3)))
            rows.append((station, day, low, low + 8 + float(rng.random()), rain, None))
    return frame(STATION_DAYS, rows).cache()


def expected(stations, station):
    """Per day the features that its station's days give, by looking up each day they name."""
    days = {r["date"]: r for r in stations.where(F.col("station_id") == station).collect()}
    value = {
        d: {"tmax_f": r["tmax"] * 9 / 5 + 32, "tmin_f": r["tmin"] * 9 / 5 + 32, "prcp_in": (r["prcp"] or 0.0) / 25.4} for d, r in days.items()
    }
    out = {}
    for d in sorted(days):
        row = dict(value[d])
        before = [value.get(d - dt.timedelta(days=k)) for k in range(15)]
        for m in ("tmax_f", "tmin_f", "prcp_in"):
            seen = [v and v[m] for v in before]
            row |= {f"{m}_l{k}": seen[k] for k in (1, 2, 3, 7, 14)}
            for n in (3, 7, 14):
                whole = None not in seen[:n]
                row[f"{m}_ma{n}"] = statistics.mean(seen[:n]) if whole else None
                row[f"{m}_std{n}"] = statistics.stdev(seen[:n]) if whole else None
        kind, run = value[d]["prcp_in"] > 0, 0
        while (back := value.get(d - dt.timedelta(days=run))) and (back["prcp_in"] > 0) == kind:
            run += 1
        row["wet_streak"], row["dry_streak"] = (run, 0) if kind else (0, run)
        angle = 2 * math.pi * d.timetuple().tm_yday / 366
        row["doy_sin"], row["doy_cos"] = math.sin(angle), math.cos(angle)
        after = value.get(d + dt.timedelta(days=1))
        row |= {"y_tmax_f": after and after["tmax_f"], "y_tmin_f": after and after["tmin_f"], "y_rain_yn": after and int(after["prcp_in"] > 0)}
        out[d] = row
    return out


def check_frame(stations, names):
    frame = weather.training_frame(weather.observations(stations))
    assert set(frame.columns) == {"station_id", "target_date", *weather.FEATURES, *weather.TARGETS, *weather.RAW}
    found = frame.collect()
    for station in names:
        want = {d: row for d, row in expected(stations, station).items() if None not in row.values()}
        got = {r["target_date"] - dt.timedelta(days=1): r for r in found if r["station_id"] == station}
        assert set(got) == set(want)
        for d, row in want.items():
            assert {c: got[d][c] for c in row} == pytest.approx(row, abs=1e-9)
    return len(found)


def test_training_frame_matches_each_day(stations):
    assert len(weather.FEATURES) == 38
    assert check_frame(stations, ["s1", "s2"]) == 2 * (40 - 14 - 1)


def test_missing_days_count_as_days(frame):
    """Gaps of one day, of two weeks and of years, against a look-up of each day."""
    rng = np.random.default_rng(9)
    rows = []
    for station, missing in (("one", {20}), ("weeks", set(range(25, 39))), ("years", set(range(30, 900))), ("many", {3, 9, 22, 41, 42, 60})):
        for i in range(940):
            if i not in missing and (i < 80 or i > 890):
                day = (dt.date(2020, 1, 1) + dt.timedelta(days=i)).isoformat()
                low = float(rng.normal(0, 5))
                rows.append((station, day, low, low + 5, float(max(0.0, rng.normal(0, 3))), None))
    stations = frame(STATION_DAYS, rows)
    assert check_frame(stations, ["one", "weeks", "years", "many"]) > 150
    streaks = {(r["station_id"], r["date"]): (r["wet_streak"], r["dry_streak"]) for r in weather.streaks(weather.observations(stations)).collect()}
    for station in ("one", "years"):
        assert all(streaks[station, d] == (row["wet_streak"], row["dry_streak"]) for d, row in expected(stations, station).items())


def test_one_exchange_for_the_whole_frame(stations):
    plan = weather.training_frame(weather.observations(stations))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_wet_and_dry_exclude_each_other(stations):
    rows = weather.streaks(weather.observations(stations)).collect()
    assert all((r["wet_streak"] > 0) == (r["dry_streak"] == 0) for r in rows)


def test_null_rain_breaks_a_wet_run_and_is_dry(frame):
    rows = [("s", f"2024-01-0{i}", r) for i, r in enumerate([1.0, 2.0, None, 0.0, 3.0], start=1)]
    got = weather.streaks(frame("station_id string, date date, prcp_in double", rows)).orderBy("date").collect()
    assert [r["wet_streak"] for r in got] == [1, 2, 0, 0, 1]
    assert [r["dry_streak"] for r in got] == [0, 0, 1, 2, 0]


def test_observations_without_snow_column(stations):
    obs = weather.observations(stations.drop("snow"), "2024-02-05", "2024-02-06")
    assert obs.count() == 4
    assert {r["snow_in"] for r in obs.collect()} == {0.0}


HOURLY = {
    "properties": {
        "periods": [
            {"startTime": "2024-03-09T23:30:00-05:00", "temperature": 50, "probabilityOfPrecipitation": {"value": 10}, "windGust": None},
            {"startTime": "2024-03-10T00:00:00-05:00", "temperature": 40, "probabilityOfPrecipitation": None, "windGust": {"value": 12}},
            {"startTime": "2024-03-10T23:30:00-04:00", "temperature": 61.5, "probabilityOfPrecipitation": {"value": None}},
            {"startTime": "2024-03-11T00:00:00-04:00", "temperature": 99},
            {"startTime": "no time", "temperature": 1},
        ]
    }
}


def test_hourly_forecast_by_local_day(frame):
    docs = frame("station_id string, body string", [("s", json.dumps(HOURLY)), ("empty", '{"properties": {}}'), ("bad", "not json")])
    hourly = feeds.hourly_forecast(docs)
    assert hourly.count() == 4
    days = {r["date"].isoformat(): tuple(r)[2:] for r in weather.hourly_to_day(hourly, "America/New_York").collect()}
    # The 10th has 23 hours; its last half hour still belongs to it.
    assert days["2024-03-10"] == (61.5, 40.0, None, 12.0)
    assert days["2024-03-09"] == (50.0, 50.0, 10.0, None)


DAILY = {
    "daily": {
        "time": ["2024-03-10", "2024-03-11"],
        "temperature_2m_max": [10.0, None],
        "temperature_2m_min": [0.0, -40.0],
        "precipitation_sum": [25.4, 0.0],
        "precipitation_probability_max": [80, 5],
        "wind_gusts_10m_max": [10.0, 0.0],
    }
}


def test_daily_forecast_arrays(frame):
    docs = frame("station_id string, body string", [("s", json.dumps(DAILY)), ("none", '{"daily": {}}')])
    rows = feeds.daily_forecast(docs).orderBy("date").collect()
    assert [tuple(r)[1:] for r in rows] == [
        (dt.date(2024, 3, 10), 50.0, 32.0, 1.0, 80.0, pytest.approx(22.3694)),
        (dt.date(2024, 3, 11), None, -40.0, 0.0, 5.0, 0.0),
    ]


def test_weather_run_scores_tomorrow(spark, stations, frame, tmp_path):
    docs = frame("station_id string, body string", [("s1", json.dumps(HOURLY))])
    arrays = frame("station_id string, body string", [("s2", json.dumps(DAILY))])
    out = weather_run(spark, stations, str(tmp_path / "w"), "2024-03-09", "America/New_York", docs, arrays)
    rows = {r["station_id"]: r for r in out["scoring"].collect()}
    assert set(rows) == {"s1", "s2"}
    base = expected(stations, "s1")[dt.date(2024, 3, 9)]
    assert rows["s1"]["tmax_f_ma7"] == pytest.approx(base["tmax_f_ma7"])
    assert rows["s1"]["target_date"] == dt.date(2024, 3, 10)
    assert (rows["s1"]["nws_tmax_f"], rows["s1"]["om_tmax_f"]) == (61.5, None)
    assert (rows["s2"]["nws_tmax_f"], rows["s2"]["om_tmax_f"]) == (None, 50.0)
    assert not set(weather.TARGETS) & set(out["scoring"].columns)
    alone = weather.scoring_frame(out["observations"], None, None, F.lit("2024-03-09").cast("date"))
    assert set(alone.columns) == set(out["scoring"].columns)
