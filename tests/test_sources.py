import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidecast.operators.backtest import DETAIL_COLUMNS
from tidecast.session import shared_folder
from tidecast.sources import sinks, tables, trades
from tidecast.sources.schemas import ACTUALS, TRADES


def write_json(folder, rows):
    folder.mkdir()
    (folder / "rows.json").write_text("\n".join(json.dumps(r) for r in rows))
    return str(folder)


def test_ridership_scan(spark, tmp_path):
    rows = [{"date": f"2024-01-0{i}T00:00:00.000", "mode": m, "count": str(i), "other": 1}
            for i, m in enumerate(["Subway", "Bus", "subway", "Subway", None], start=1)]
    path = write_json(tmp_path / "raw", rows)
    assert tables.ridership(spark, path).count() == 2
    assert tables.ridership(spark, path, mode=None).count() == 5
    first = tables.ridership(spark, path, mode=None, limit=1).first()
    assert first["date"].startswith("2024-01-01") and first.asDict().keys() == {"date", "mode", "count"}
    plan = tables.ridership(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(mode), EqualTo(mode,Subway)]" in plan


def test_actuals_on_days(spark, frame, tmp_path):
    path = str(tmp_path / "actuals")
    rows = frame(ACTUALS, [("a", f"2024-01-0{i}", i) for i in range(1, 6)])
    sinks.overwrite_table(rows, path)
    assert sorted(r["y"] for r in tables.actuals_on(spark, path, ["2024-01-02", "2024-01-05", "2024-02-01"]).collect()) == [2.0, 5.0]
    assert tables.actuals_on(spark, path, []).count() == 0
    sinks.overwrite_table(rows.limit(1), path)
    assert spark.read.parquet(path).count() == 1


def test_prediction_log_appends(spark, frame, tmp_path):
    rows = frame("series_id string, target_date date, predicted double", [("a", "2024-01-01", 1.25)])
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        for as_of in ("2024-01-01 10:00:00", "2024-01-02 10:00:00"):
            sinks.append_predictions(rows, path, F.lit(as_of), fmt=fmt)
        log = tables.prediction_log(spark, path, fmt)
        assert log.count() == 2 and log.select(F.max("predicted_at").cast("string")).first()[0] == "2024-01-02 10:00:00"


def test_first_usable(frame):
    good = frame("mode string, predicted double, actual double", [("Iterative", 1, 2)])
    other = frame("mode string, predicted double, actual double", [("multi", 1, 2)])
    lacking = frame("mode string, predicted double", [("iterative", 1)])
    needed = ("mode", "predicted", "actual")
    assert tables.first_usable([None, lacking, other, good], needed) is good
    assert tables.first_usable([None, lacking, other, good], needed, mode=None) is other
    assert tables.first_usable([None, lacking], needed) is None


def test_station_days_range_and_empty(spark, frame, tmp_path):
    path = str(tmp_path / "st")
    frame("station_id string, date date, tmin double, tmax double, prcp double, snow double",
          [("s", f"2024-01-0{i}", 1, 2, 3, 4) for i in range(1, 6)]).write.parquet(path)
    assert tables.station_days(spark, path, "2024-01-02", "2024-01-04").count() == 3
    with pytest.raises(ValueError, match="station observations"):
        tables.station_days(spark, path, "2030-01-01")


@pytest.fixture(scope="module")
def listing(spark):
    return spark.range(237).select(
        F.col("id").alias("trade_id"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("ticker"),
        F.floor(F.col("id") / 5).cast("long").alias("ts"),
    ).repartition(6)


def test_pages_joined_give_the_full_listing(listing):
    seen, cursor = [], None
    while True:
        page = trades.trades_page(listing, 50, cursor, ticker="B", min_ts=3, max_ts=40)
        rows = page.collect()
        if not rows:
            break
        seen += rows
        cursor = trades.page_cursor(page)
    want = trades.filtered_trades(listing, "B", 3, 40).orderBy("ts", "trade_id").collect()
    assert seen == want
    placed = trades.paged_listing(listing, 50, ticker="B", min_ts=3, max_ts=40).orderBy("page", "place").collect()
    assert [r["trade_id"] for r in placed] == [r["trade_id"] for r in want]
    assert [(r["page"], r["place"]) for r in placed] == [(i // 50, i % 50) for i in range(len(want))]


def test_null_arguments_filter_nothing(listing):
    assert trades.trades_page(listing).count() == 237
    assert trades.page_cursor(trades.trades_page(listing, 5, (10**9, 0))) is None


def test_page_is_a_top_n(listing):
    plan = trades.trades_page(listing, 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_detail_columns_order():
    assert DETAIL_COLUMNS[:5] == ("train_end", "mode", "target_date", "step", "predicted")
    assert TRADES.startswith("trade_id")


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", spark.sparkContext.getCheckpointDir())
    assert spark.sparkContext.getCheckpointDir() is not None


def test_days_of_another_table_prune_the_months(spark, frame, tmp_path):
    path = str(tmp_path / "counts")
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(300)]
    sinks.write_by_month(frame("date date, mode string, count long", [(d, m, i) for i, d in enumerate(days) for m in ("Subway", "subway", "Bus")]), path)
    wanted = frame("date date, k int", [("2024-03-05", 1), ("2024-03-05", 1), (None, 1), ("2024-06-30", 1), ("2024-08-01", 2), ("2030-01-01", 1)])
    wanted.write.parquet(str(tmp_path / "wanted"))
    got = tables.counts_on(spark, path, spark.read.parquet(str(tmp_path / "wanted")).where("k = 1"))
    assert sorted((r["date"].isoformat(), r["mode"]) for r in got.collect()) == [("2024-03-05", "Subway"), ("2024-06-30", "Subway")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "PushedFilters: [IsNotNull(mode), EqualTo(mode,Subway)" in plan
    assert tables.counts_on(spark, path, wanted, None).count() == 9
