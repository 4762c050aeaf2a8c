import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidecast.operators import models, weekly
from tidecast.plans.weekly_run import quality_checks, require_output, run_records, weekly_run
from tidecast.sources import sinks
from tidecast.sources.schemas import ACTUALS, PREDICTION_LOG

MODELS = {"single": models.seasonal_naive(), "multi": models.lag_mean((7, 14, 21)), "iterative": models.lag_mean()}


def log_rows(frame, rows, series="a"):
    return frame(PREDICTION_LOG, [(series, d, p, at) for d, p, at in rows])


def actual_rows(frame, rows, series="a"):
    return frame(ACTUALS, [(series, d, y) for d, y in rows])


WEEK = [f"2024-01-{d:02d}" for d in range(8, 15)]  # Monday to Sunday


def test_latest_prediction_skips_nulls(frame):
    log = log_rows(
        frame,
        [("2024-01-08", 1, "2024-01-01T10:00:00"), ("2024-01-08", 2, "2024-01-02T10:00:00"), ("2024-01-08", None, "2024-01-03T10:00:00"),
         ("2024-01-09", 5, "2024-01-02T10:00:00"), ("2024-01-09", 7, "2024-01-02T10:00:00")],
    )
    got = {r["target_date"].day: r["predicted"] for r in weekly.latest_predictions(log).collect()}
    assert got == {8: 2.0, 9: 7.0}


def test_week_mixes_predictions_and_actuals(frame):
    log = log_rows(frame, [(d, 10 + i, "2024-01-07T00:00:00") for i, d in enumerate(WEEK) if i >= 2] + [("2024-01-03", 99, "2024-01-07T00:00:00")])
    actuals = actual_rows(frame, [(WEEK[0], 100), (WEEK[1], 101), (WEEK[3], 500)])
    days = weekly.week_days(log, actuals).orderBy("date").collect()
    assert [r["ridership"] for r in days] == [100, 101, 12, 13, 14, 15, 16]
    assert [r["data_type"] for r in days] == ["actual"] * 2 + ["predicted"] * 5
    row = weekly.weekly_numbers(weekly.week_days(log, actuals)).first()
    assert row["num_days"] == 7 and row["is_complete_week"] and row["has_mixed_data"]
    assert row["daily_average"] * 7 == pytest.approx(row["total_period_ridership"])
    assert row["period_description"] == "2024-01-08 to 2024-01-14"
    assert row["daily_breakdown"]["Monday"]["data_type"] == "actual"
    assert row["daily_breakdown"]["Sunday"].asDict() == {"date": dt.date(2024, 1, 14), "ridership": 16, "data_type": "predicted"}


def test_mixed_flag_is_set_even_without_an_actual(frame):
    log = log_rows(frame, [(d, 10, "2024-01-07T00:00:00") for d in WEEK[1:]])
    days = weekly.week_days(log, actual_rows(frame, []))
    assert weekly.weekly_numbers(days).count() == 0
    row = weekly.weekly_numbers(days, allow_partial=True, log=log).first()
    assert (row["num_days"], row["is_complete_week"], row["has_mixed_data"]) == (6, False, True)


def test_empty_week_falls_back_to_all_days(frame):
    log = log_rows(
        frame,
        [("2024-01-01", 3, "2024-01-01T00:00:00"), ("2024-01-02", 5, "2024-01-01T00:00:00"), ("2024-01-08", 9, "2024-01-01T00:00:00"),
         ("2024-01-15", None, "2024-01-01T00:00:00")],
    )
    days = weekly.week_days(log, actual_rows(frame, []))
    row = weekly.weekly_numbers(days, allow_partial=True, log=log).first()
    assert (row["num_days"], row["has_mixed_data"], row["period_description"]) == (3, False, "2024-01-01 to 2024-01-08")
    assert row["daily_breakdown"]["Monday"]["ridership"] == 9  # the later Monday stays


def test_missing_days_and_their_actuals(frame):
    log = log_rows(frame, [(WEEK[6], 1, "2024-01-07T00:00:00")])
    missing = weekly.missing_days(log)
    assert sorted(r["date"].isoformat() for r in missing.collect()) == WEEK[:6]
    found = weekly.actuals_for(actual_rows(frame, [(WEEK[0], 5), (WEEK[6], 6), ("2024-02-01", 7)]), missing)
    assert [r["y"] for r in found.collect()] == [5.0]


def test_recent_week(frame):
    log = log_rows(frame, [(d, 1, "2024-01-07T00:00:00") for d in WEEK] * 2 + [("2024-01-16", 1, "2024-01-07T00:00:00")])
    log = log.unionByName(log_rows(frame, [(d, 1, "2024-01-07T00:00:00") for d in WEEK[3:]], "short"))
    log = log.unionByName(log_rows(frame, [(WEEK[0], 1, "2024-01-07T00:00:00")], "no sunday"))
    weeks = {r["series_id"]: (r["monday"].isoformat(), r["num_days"]) for r in weekly.newest_sunday_week(log).collect()}
    assert weeks == {"a": ("2024-01-08", 7), "short": ("2024-01-08", 4)}
    assert weekly.recent_complete_week(log).count() == 14
    with pytest.raises(PySparkException, match="incomplete week"):
        weekly.recent_complete_week(log, strict=True).collect()


@pytest.mark.parametrize("value, whole", [(0.5, 0), (1.5, 2), (2.5, 2), (-0.5, 0), (2.4999999999, 2), (7.51, 8)])
def test_half_even(frame, value, whole):
    assert frame("v double", [(value,)]).select(weekly.half_even(F.col("v"))).first()[0] == whole


def test_summary_row_and_upsert(spark, frame, tmp_path):
    log = log_rows(frame, [(d, 10.5, "2024-01-07T00:00:00") for d in WEEK])
    numbers = weekly.weekly_numbers(weekly.week_days(log, actual_rows(frame, [])))
    path = str(tmp_path / "summary")
    assert sinks.read_keyed(spark, path) is None
    for day in ("2024-01-14", "2024-01-15", "2024-01-15"):
        sinks.upsert_keyed(weekly.summary_rows(numbers, F.lit(day)), path, ["series_id", "calculation_date"], "calculation_date")
    rows = sinks.read_keyed(spark, path).collect()
    assert [r["calculation_date"].isoformat() for r in rows] == ["2024-01-15", "2024-01-14"]
    assert tuple(rows[0].asDict()[c] for c in weekly.SUMMARY_COLUMNS[:6]) == (
        "2024-01-08 to 2024-01-14", "complete_week", "predictions_only", 7, 10, 74)


def test_weekly_json(frame):
    log = log_rows(frame, [(d, 10, "2024-01-07T00:00:00") for d in WEEK])
    numbers = weekly.weekly_numbers(weekly.week_days(log, actual_rows(frame, [])))
    doc = json.loads(sinks.weekly_json(numbers, F.lit("2024-01-15 01:02:03")).first()[0])
    assert doc["start_date"] == "2024-01-08" and doc["num_days"] == 7
    assert doc["daily_breakdown"]["Friday"] == {"date": "2024-01-12", "ridership": 10, "data_type": "predicted"}
    assert doc["calculation_timestamp"].startswith("2024-01-15T01:02:03")


def test_weekly_run_stages_and_skips(spark, daily, tmp_path):
    rows = daily(89).unionByName(daily(89, series="b", value=lambda i: 5.0 + i % 7))
    base = str(tmp_path / "run")
    out = weekly_run(spark, rows, base, "2024-03-30 09:00:00", MODELS)
    assert out["summary"].count() == 2
    logged = out["predictions"].count()
    assert logged == 2 * 2  # the last day is a Friday
    assert out["bias"].count() == 14 and out["switch"].count() == 2
    again = weekly_run(spark, rows, base, "2024-03-30 18:00:00", MODELS, skip=("backtest", "calibrate"), switch=1, bias=0.0)
    assert again["predictions"].count() == 2 * logged
    assert require_output(spark, base).count() == 2
    newest = weekly.latest_predictions(again["predictions"]).where("series_id = 'b'").orderBy("target_date").collect()
    assert newest[0]["predicted"] == pytest.approx(sum(5.0 + (89 - k) % 7 for k in (1, 2, 3, 4, 5, 6, 7, 14, 21)) / 9)
    with pytest.raises(ValueError, match="unknown stages"):
        weekly_run(spark, rows, base, "2024-03-30 18:00:00", MODELS, skip=("nothing",))
    with pytest.raises(ValueError, match="no weekly summary"):
        require_output(spark, str(tmp_path / "none"))


def test_weekly_run_with_learners(spark, daily, tmp_path):
    from tidecast.operators.learners import Learner

    rows = daily(80)
    out = weekly_run(
        spark, rows, str(tmp_path / "run"), "2024-03-20 09:00:00", {m: Learner("linear") for m in MODELS}, newest=2
    )
    assert out["summary"].count() == 1
    assert out["predictions"].where("predicted is null").count() == 0


def test_weekly_run_with_its_defaults(spark, daily, tmp_path):
    """The documented learners, from backtest to summary, over the ten documented cutoffs."""
    rows = daily(110, value=lambda i: 1000.0 + 50 * (i % 7)).unionByName(daily(110, value=lambda i: 10.0 + i % 7, series="b"))
    out = weekly_run(spark, rows, str(tmp_path / "run"), "2024-04-20 09:00:00")
    detail = out["backtest"].groupBy("series_id", "mode").agg(F.countDistinct("train_end").alias("n"), F.avg("abs_error").alias("e")).collect()
    assert {(r["series_id"], r["mode"], r["n"]) for r in detail} == {(s, m, 10) for s in "ab" for m in MODELS}
    assert all(r["e"] < (50 if r["series_id"] == "a" else 1) for r in detail)
    assert out["bias"].count() == 14 and out["switch"].count() == 2
    assert out["predictions"].where("predicted is null").count() == 0
    assert {r["series_id"]: r["num_days"] for r in out["summary"].collect()} == {"a": 7, "b": 7}


def test_a_stage_that_fails_leaves_the_table_before(spark, daily, tmp_path, monkeypatch):
    base, rows = str(tmp_path / "run"), daily(89)
    skip = ("forecast", "rollup")
    weekly_run(spark, rows, base, "2024-03-30 09:00:00", MODELS, skip=skip)
    before = {r["table"]: r.asDict() for r in run_records(spark, base).collect()}
    assert {t: r["stage"] for t, r in before.items()} == {"series": "series", "backtest": "backtest", "bias": "calibrate", "switch": "calibrate"}
    assert (before["series"]["n_rows"], before["bias"]["n_rows"], before["switch"]["n_rows"], before["series"]["n_nulls"]) == (89, 7, 1, 0)

    def broken(detail, keys):
        """Fails in the middle of the write: some rows come, one does not."""
        bad = F.when(F.col("weekday") == 5, F.raise_error(F.lit("stopped in the middle")).cast("double")).otherwise(1.0)
        return detail.sparkSession.range(0, 7, 1, 7).select(F.lit("a").alias("series_id"), F.col("id").cast("int").alias("weekday")).withColumn("bias", bad)

    monkeypatch.setattr("tidecast.plans.weekly_run.weekday_bias", broken)
    with pytest.raises(Exception, match="stopped in the middle"):
        weekly_run(spark, rows, base, "2024-03-31 09:00:00", MODELS, skip=skip, newest=3)
    after = {r["table"]: r.asDict() for r in run_records(spark, base).collect()}
    assert after["bias"] == before["bias"] and after["switch"] == before["switch"]
    assert after["backtest"]["as_of"] == "2024-03-31 09:00:00" and after["backtest"]["n_rows"] < before["backtest"]["n_rows"]
    monkeypatch.undo()
    out = weekly_run(spark, rows, base, "2024-03-31 10:00:00", MODELS, skip=("backtest", "calibrate"))
    assert out["bias"].count() == 7 and out["summary"].count() == 1
    weekly_run(spark, rows, base, "2024-03-31 11:00:00", MODELS, skip=skip)
    assert len(list((tmp_path / "run" / "bias").glob("rows-*"))) == 2  # what failed is gone
    with pytest.raises(ValueError, match="stage backtest has not been run"):
        weekly_run(spark, rows, str(tmp_path / "other"), "2024-03-31 09:00:00", MODELS, skip=("backtest",))


def test_quality_checks(frame, daily):
    predictions = frame("series_id string, predicted double", [("a", 105), ("a", 1e9)])
    row = quality_checks(daily(10).unionByName(daily(4, series="b")), predictions, "2024-01-12").orderBy("series_id").collect()
    assert (row[0]["age_days"], row[0]["is_fresh"], row[0]["in_range"], row[0]["n_predictions"]) == (2, True, False, 2)
    assert (row[1]["age_days"], row[1]["is_fresh"], row[1]["n_predictions"]) == (8, False, 0)


def test_versions_kept_and_doubled_keys(spark, frame, tmp_path):
    path = str(tmp_path / "keyed")
    schema = "k string, v int, at int"
    for n in range(6):
        sinks.upsert_keyed(frame(schema, [("a", n, 1), (f"b{n}", n, 1)]), path, ["k"], keep=2)
    assert sinks.versions(spark, path) == [5, 6]
    assert {r["k"]: r["v"] for r in sinks.read_keyed(spark, path).collect()} == {"a": 5, **{f"b{n}": n for n in range(6)}}
    doubled = frame(schema, [("a", 7, 2), ("a", 8, 1)])
    with pytest.raises(Exception, match="doubled key"):
        sinks.upsert_keyed(doubled, path, ["k"])
    assert sinks.versions(spark, path)[-1] == 6
    sinks.upsert_keyed(doubled, path, ["k"], order="at")
    assert {r["k"]: r["v"] for r in sinks.read_keyed(spark, path).collect()}["a"] == 7


def bucket_folders(path):
    return {f"{f.parent.name}/{f.name}": f.stat().st_mtime_ns for f in path.glob("_bucket=*/_version=*")}


def test_a_write_leaves_other_buckets_alone(spark, frame, tmp_path):
    path = tmp_path / "keyed"
    rows = [(f"k{i}", i) for i in range(400)]
    sinks.upsert_keyed(frame("k string, v int", rows), str(path), ["k"], keep=1, buckets=16)
    before = bucket_folders(path)
    assert len(before) == 16
    sinks.upsert_keyed(frame("k string, v int", [("k5", -1)]), str(path), ["k"], keep=1)
    after = bucket_folders(path)
    assert len(after) == 16 and len(set(after.items()) & set(before.items())) == 15
    assert {r["k"]: r["v"] for r in sinks.read_keyed(spark, str(path)).collect()} == dict(rows) | {"k5": -1}
    sizes = spark.read.parquet(str(path)).groupBy("_bucket").count().collect()
    assert max(r["count"] for r in sizes) < 2 * 400 / 16


def test_a_failed_write_changes_nothing(spark, frame, tmp_path, monkeypatch):
    path = tmp_path / "keyed"
    table = str(path)

    def current():
        return {r["k"]: r["v"] for r in sinks.read_keyed(spark, table).collect()}

    rows = {f"k{i}": i for i in range(50)}
    sinks.upsert_keyed(frame("k string, v int", list(rows.items())), table, ["k"], buckets=4)
    commit = sinks._commit
    monkeypatch.setattr(sinks, "_commit", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError, match="stopped"):
        sinks.upsert_keyed(frame("k string, v int", [("k1", -1), ("x", 0)]), table, ["k"])
    monkeypatch.setattr(sinks, "_commit", commit)
    assert current() == rows and sinks.versions(spark, table) == [1]
    assert len(bucket_folders(path)) > 4  # left by the failed write
    sinks.upsert_keyed(frame("k string, v int", [("k2", -2)]), table, ["k"], keep=1)
    assert current() == rows | {"k2": -2} and sinks.versions(spark, table) == [2]
    assert len(bucket_folders(path)) == 4
    with pytest.raises(ValueError, match="written by another job"):
        sinks._commit(spark, table, 2, {})
    sinks.upsert_keyed(frame("k string, v int", []), table, ["k"])  # nothing new
    assert current() == rows | {"k2": -2}


def test_new_rows_are_worked_out_once_a_write(spark, frame, tmp_path):
    """Buckets, anti-join and write read the same rows, though making them twice gives others."""
    path, made = tmp_path / "keyed", spark.sparkContext.accumulator(0)

    def counted(row):
        made.add(1)
        return row

    def rows(n):
        seen = spark.createDataFrame(spark.sparkContext.parallelize([(i,) for i in range(n)], 2).map(counted), "v long")
        return seen.select(F.expr("uuid()").alias("k"), "v")

    for n in (40, 25):
        sinks.upsert_keyed(rows(n), str(path), ["k"])
    assert made.value == 65
    assert sinks.read_keyed(spark, str(path)).count() == 65
    assert not list(path.glob("_staged*"))


def test_null_keys_and_old_versions(spark, frame, tmp_path):
    table = str(tmp_path / "keyed")
    for v in range(3):
        sinks.upsert_keyed(frame("k string, j int, v int", [("a", None, v), ("b", 1, v)] if v != 1 else [("b", 1, v)]), table, ["k", "j"], keep=3)
    assert sinks.versions(spark, table) == [1, 2, 3]
    first = sinks._rows(spark, table, sinks.manifest(spark, table, 1)).collect()
    assert sorted(r["v"] for r in first) == [0, 0]


def test_skipped_weeks_have_a_reason(frame):
    days = frame("series_id string, week_start date, date date, ridership double", [("a", "2024-01-01", f"2024-01-0{k}", None if k > 3 else 1.0) for k in range(1, 8)] + [("b", "2024-01-01", f"2024-01-0{k}", 1.0) for k in range(1, 8)] + [("c", "2024-01-01", "2024-01-01", None)])
    got = {r["series_id"]: (r["num_days"], r["reason"]) for r in weekly.skipped_weeks(days).collect()}
    assert got == {"a": (3, "only 3 of 7 days"), "c": (0, "no value in the week")}
