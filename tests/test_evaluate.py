import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import error_sums
from tidecast.operators import evaluate as ev
from tidecast.operators.ranking import counted_values
from tidecast.operators import forecast as fc
from tidecast.operators import models
from tidecast.operators import backtest as bt
from tidecast.operators.ranking import exact_quantiles, global_position

MODELS = {"single": models.seasonal_naive(), "multi": models.lag_mean((7, 14, 21)), "iterative": models.lag_mean()}
DETAIL = (
    "series_id string, train_end date, mode string, target_date date, step int, predicted double, actual double, "
    "error double, abs_error double, squared_error double"
)


@pytest.fixture(scope="module")
def detail(frame):
    rng = random.Random(7)
    rows = []
    for key in "ab":
        for c in range(10):
            end = dt.date(2024, 3, 4) + dt.timedelta(days=c)
            for step in range(1, 8 - end.weekday() if end.weekday() < 6 else 8):
                target = end + dt.timedelta(days=step)
                actual = 1000 + rng.random() * 100
                for mode in fc.MODES:
                    if mode == "single" and step > 1:
                        continue
                    p = actual + rng.gauss(-20, 30)
                    e = p - actual
                    rows.append((key, end.isoformat(), mode, target.isoformat(), step, p, actual, e, abs(e), e * e))
    return frame(DETAIL, rows).cache()


def test_switch_at_the_horizon_is_pure_iterative(detail):
    pivoted = ev.pivot_modes(detail, ("series_id",))
    last = ev.switch_sweep(pivoted).where("switch = 7").first()
    pure = ev.overall_metrics(detail).where("mode = 'iterative'").first()
    assert last["MAE"] == pytest.approx(pure["MAE"])
    assert last["MSE"] == pytest.approx(pure["MSE"])


def test_calibrated_mean_error_is_zero(detail):
    keys = ("series_id",)
    pivoted = ev.pivot_modes(detail, keys)
    rows = ev.switch_sweep(pivoted, keys, ev.global_bias(pivoted, keys)).where("switch = 7").collect()
    assert len(rows) == 2
    assert all(abs(r["MeanError"]) < 1e-9 for r in rows)


def test_sweep_by_hand(detail):
    rows = ev.pivot_modes(detail, ("series_id",)).collect()
    for s in ev.switch_sweep(ev.pivot_modes(detail, ("series_id",))).collect():
        errors = [
            (r["iterative_predicted"] if r["step"] <= s["switch"] else r["multi_predicted"]) - r["actual"] for r in rows
        ]
        assert s["MAE"] == pytest.approx(np.mean(np.abs(errors)))
        assert s["MSE"] == pytest.approx(np.mean(np.square(errors)))


def test_weekday_bias_removes_the_mean_error_of_each_weekday(detail):
    keys = ("series_id",)
    calibrated = bt.with_errors(
        ev.apply_bias(detail.drop("error", "abs_error", "squared_error"), ev.weekday_bias(detail, keys), keys)
    )
    left = calibrated.where("mode = 'iterative'").groupBy("series_id", F.weekday("target_date")).agg(F.avg("error").alias("e"))
    assert all(abs(r["e"]) < 1e-9 for r in left.collect())
    untouched = calibrated.where("mode = 'multi'").select(F.sum("error")).first()[0]
    assert untouched == pytest.approx(detail.where("mode = 'multi'").select(F.sum("error")).first()[0])


def test_bias_before_a_cutoff_ignores_later_errors(detail):
    keys = ("series_id",)
    got = {(r["series_id"], r["train_end"], r["weekday"]): r["bias"] for r in ev.weekday_bias_before(detail, keys).collect()}
    rows = detail.where("mode = 'iterative'").collect()
    assert len(got) == 2 * 10 * 7
    for (key, end, wd), bias in got.items():
        past = [r["error"] for r in rows if r["series_id"] == key and r["target_date"] <= end and r["target_date"].weekday() == wd]
        assert bias == pytest.approx(-np.mean(past) if past else 0.0)


def step_rows(frame, it, mu):
    out = []
    for mode, errors in (("iterative", it), ("multi", mu)):
        for step, e in errors.items():
            out.append(("a", "2024-01-01", mode, "2024-01-02", step, 0, 0, e, abs(e), e * e))
    return frame(DETAIL, out)


def test_best_switch(frame):
    it = {1: 1, 2: 2, 3: 9, 4: 9, 5: 9, 6: 9, 7: 9}
    mu = {1: 5, 2: 5, 3: 3, 4: 3, 5: 3, 6: 3, 7: 3}
    assert ev.best_switch(step_rows(frame, it, mu)).first()["switch"] == 2
    flat = {k: 4 for k in range(1, 8)}
    assert ev.best_switch(step_rows(frame, flat, flat)).first()["switch"] == 1
    # A step that was never run costs infinity: multi lacks step 3, so the switch must be 3 or more.
    assert ev.best_switch(step_rows(frame, flat, {k: 1 for k in (1, 2, 4, 5, 6, 7)})).first()["switch"] == 3
    assert ev.best_switch(step_rows(frame, it, mu), horizon=1).first()["switch"] == 1
    tagged = step_rows(frame, it, mu).withColumn("horizon", F.lit(2))
    assert ev.best_switch(tagged, ("series_id",), "horizon").first()["switch"] == 2


def test_exact_quantiles_with_a_hot_group_and_ties(spark):
    rng = random.Random(3)
    data = [("hot", float(rng.randint(0, 50))) for _ in range(3000)] + [("cold", rng.random()) for _ in range(7)] + [("one", 4.0)]
    df = spark.createDataFrame(data + [("cold", None)], "g string, v double").repartition(5)
    wanted = {"q1": 0.25, "median": 0.5, "p99": 0.99}
    rows = exact_quantiles(df, ["g"], "v", wanted).collect()
    assert {r["g"] for r in rows} == {"hot", "cold", "one"}
    for r in rows:
        own = [v for g, v in data if g == r["g"]]
        for name, q in wanted.items():
            assert r[name] == pytest.approx(np.quantile(own, q))


def test_global_position_is_a_permutation(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k")).repartition(9)
    rows = global_position(df, ["k"], "p").collect()
    assert sorted((r["p"], r["k"]) for r in rows) == [(i, i) for i in range(5000)]


def test_error_distribution_hides_outliers(frame):
    errors = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0]
    rows = [("a", "2024-01-01", "multi", "2024-01-02", 1, 0, 0, e, e, e) for e in errors]
    box = ev.error_distribution(frame(DETAIL, rows)).first()
    assert (box["count"], box["q1"], box["median"], box["q3"]) == (9, 3.0, 5.0, 7.0)
    assert (box["whisker_low"], box["whisker_high"]) == (1.0, 8.0)


def test_residuals_skip_absent_modes(detail):
    rows = ev.residuals(ev.pivot_modes(detail.where("mode = 'iterative'"), ("series_id",)), ("series_id",)).collect()
    assert {r["mode"] for r in rows} == {"iterative"}


def test_modes_over_real_backtest_add_up(daily):
    detail = bt.run(daily(90), {"single": models.seasonal_naive(), "multi": models.lag_mean((7, 14, 21)), "iterative": models.lag_mean()})
    per_step = ev.horizon_metrics(detail).collect()
    overall = {r["mode"]: r["count"] for r in ev.overall_metrics(detail).collect()}
    for mode in fc.MODES:
        assert sum(r["count"] for r in per_step if r["mode"] == mode) == overall[mode]


def test_best_switch_beyond_a_week(frame):
    it = {k: (1 if k <= 10 else 9) for k in range(1, 13)}
    mu = dict.fromkeys(range(1, 13), 5)
    tagged = step_rows(frame, it, mu).withColumn("series_id", F.lit("a"))
    assert ev.best_switch(tagged, ("series_id",), 12).first()["switch"] == 10
    assert ev.best_switch(tagged.withColumn("h", F.lit(12)), ("series_id",), "h").first()["switch"] == 10
    horizons = frame("series_id string, horizon int", [("a", 9), ("b", 3)])
    assert [tuple(r) for r in ev.best_switch(tagged, ("series_id",), horizons).collect()] == [("a", 9)]


def test_own_modes_are_measured_too(frame):
    detail = frame("mode string, error double, abs_error double, squared_error double", [("trend", -2, 2, 4), ("multi", 1, 1, 1)])
    got = {r["mode"]: (r["count"], r["MeanError"]) for r in ev.overall_metrics(detail).collect()}
    assert got == {"trend": (1, -2.0), "multi": (1, 1.0), "single": (0, None), "iterative": (0, None)}


def test_ties_do_not_fill_one_partition(spark):
    """Nine of ten rows hold one value: they are one row before anything is sorted."""
    rows = spark.range(100_000).select(F.lit("g").alias("g"), F.when(F.col("id") % 10 > 0, 0.0).otherwise(F.col("id") * 1.0).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counted = counted_values(rows, ["g"], "v")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in counted.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 10_000 and max(sizes) <= 0.6 * sum(sizes)
    assert counted.agg(F.sum("n")).first()[0] == 100_000
    assert ev.error_distribution(rows.select(F.lit("m").alias("mode"), F.lit(1).alias("step"), F.col("v").alias("error"))).first()["median"] == 0.0


def test_sums_of_runs_equal_the_rows(spark, tmp_path, daily):
    """Metrics from runs added one by one, one of them repeated, against those of all rows at once."""
    rows = daily(120).unionByName(daily(90, value=lambda i: 7.0 + (i * i) % 31, series="b"))
    detail = bt.run(rows, MODELS).cache()
    path = str(tmp_path / "sums")
    ends = sorted(r[0] for r in detail.select("train_end").distinct().collect())
    for first, last in ((0, 4), (4, 9), (9, 99), (4, 9)):
        error_sums.store_error_sums(detail.where(F.col("train_end").isin(ends[first:last])), path)
    sums = error_sums.read_error_sums(spark, path)
    assert sums.count() == error_sums.error_sums(detail).count()

    def same(a, b):
        columns = sorted(a.columns)
        assert columns == sorted(b.columns)
        left, right = (sorted(tuple(r[c] for c in columns) for r in df.collect()) for df in (a, b))
        assert len(left) == len(right) and all(x == pytest.approx(y) if not isinstance(x, str) else x == y for p, q in zip(left, right) for x, y in zip(p, q))

    for keys in ((), ("series_id",)):
        same(error_sums.overall_metrics(sums, keys), ev.overall_metrics(detail, keys))
        same(error_sums.horizon_metrics(sums, keys), ev.horizon_metrics(detail, keys))
        same(error_sums.weekday_bias(sums, keys), ev.weekday_bias(detail, keys))
        same(error_sums.global_bias(sums, keys), ev.global_bias_of_detail(detail, keys))
        same(error_sums.best_switch(sums, keys), ev.best_switch(detail, keys))
        same(error_sums.switch_sweep(sums, keys), ev.switch_sweep(ev.pivot_modes(detail, ("series_id",)), keys))
    late = error_sums.read_error_sums(spark, path, ends[-2].isoformat())
    same(error_sums.overall_metrics(late), ev.overall_metrics(detail.where(F.col("train_end") >= ends[-2])))
    assert "PartitionFilters: [isnotnull(train_end" in late._jdf.queryExecution().toString()
