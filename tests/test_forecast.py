import datetime as dt
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import backtest as bt
from tidecast.operators import evaluate as ev
from tidecast.operators import forecast as fc
from tidecast.operators import learners, models, series
from tidecast.operators.boosting import Trees, in_step
from tidecast.operators.calendar import CALENDAR_COLUMNS, with_calendar
from tidecast.plans import catalogue

MODELS = {"single": models.seasonal_naive(), "multi": models.lag_mean((7, 14, 21)), "iterative": models.lag_mean()}


def paths(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["series_id"], r["mode"]), {})[r["step"]] = (r["target_date"], r["predicted"])
    return out


def test_iterated_lag_mean_by_hand(daily):
    seen = daily(60, value=lambda i: float((i * 17) % 53))
    hist = [float((i * 17) % 53) for i in range(60)]
    origin = dt.date(2024, 1, 1) + dt.timedelta(days=59)
    horizon = 6 - origin.weekday() or 7
    got = paths(fc.forecast(fc.origins(seen), {"iterative": models.lag_mean()}))[("a", "iterative")]
    assert sorted(got) == list(range(1, horizon + 1))
    for step in range(1, horizon + 1):
        value = sum(hist[-k] for k in series.TARGET_LAGS) / 9
        hist.append(value)
        assert got[step] == (origin + dt.timedelta(days=step), pytest.approx(value))


def test_one_step_agrees_between_modes(daily):
    one = models.lag_mean()
    got = paths(fc.forecast(fc.origins(daily(50)), {"iterative": one, "multi": one, "single": one}))
    firsts = {got[("a", m)][1] for m in fc.MODES}
    assert len(firsts) == 1


def test_seasonal_naive_repeats_the_week(daily):
    seen = daily(56, value=lambda i: float(i % 7))
    got = paths(fc.forecast(fc.origins(seen), {"multi": models.seasonal_naive(), "iterative": models.seasonal_naive()}))
    assert got[("a", "multi")] == got[("a", "iterative")]
    assert [got[("a", "multi")][s][1] for s in range(1, 8)] == [float((55 + s) % 7) for s in range(1, 8)]


def test_trend_continues_a_line(daily):
    rows = fc.forecast_trend(daily(30, value=lambda i: 3.0 * i)).orderBy("step").collect()
    assert [r["predicted"] for r in rows] == pytest.approx([3.0 * (29 + r["step"]) for r in rows])


def test_holdout_zero_actual_has_no_percentage(daily):
    seen = daily(30, value=lambda i: 0.0 if i == 29 else 9.0)
    row = fc.holdout_last_day(seen, models.lag_mean()).first()
    assert (row["predicted"], row["actual"], row["abs_error"], row["pct_error"]) == (pytest.approx(9.0), 0.0, pytest.approx(9.0), None)


def test_short_series_have_no_forecast(daily):
    both = daily(40).unionByName(daily(10, series="b"))
    assert {r["series_id"] for r in fc.forecast(fc.origins(both), {"iterative": models.lag_mean()}).collect()} == {"a"}


def test_cutoffs_are_the_newest_ten_with_a_full_week(daily):
    seen = daily(80, missing={70})
    rows = bt.cutoffs(seen).orderBy("train_end").collect()
    last = dt.date(2024, 1, 1) + dt.timedelta(days=79)
    assert len(rows) == 10
    for r in rows:
        assert r["train_end"] + dt.timedelta(days=r["horizon"]) <= last
        assert r["train_end"] >= dt.date(2024, 1, 31)
        assert r["train_end"] != dt.date(2024, 1, 1) + dt.timedelta(days=70)


def test_backtest_never_scores_filled_days_and_does_not_look_ahead(daily):
    seen = daily(90, missing={72, 75, 76}, value=lambda i: float((i * 29) % 97))
    detail = bt.run(seen, MODELS).collect()
    known = {r["date"]: r["y"] for r in seen.collect()}
    assert detail
    for r in detail:
        assert known[r["target_date"]] == r["actual"]
    cutoff = sorted({r["train_end"] for r in detail})[0]
    cut = seen.where(F.col("date") <= F.lit(cutoff))
    alone = paths(fc.forecast(fc.origins(cut), MODELS))
    for r in detail:
        if r["train_end"] == cutoff:
            assert alone[("a", r["mode"])][r["step"]][1] == pytest.approx(r["predicted"])


def test_backtest_uses_two_exchanges_at_most(daily):
    totals = series.daily_totals(daily(60).withColumnRenamed("y", "v"), F.col("v"))
    plan = bt.run(totals, MODELS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan


def test_short_warmup_lists_skipped_pairs(daily):
    rows = bt.skipped(daily(40), warmup=0, newest=100).collect()
    assert {r["mode"] for r in rows} == set(fc.MODES)
    assert max(r["train_end"] for r in rows) == dt.date(2024, 1, 20)
    assert bt.skipped(daily(90)).count() == 0


def test_score_predictions_drops_unobserved(frame):
    predictions = frame(
        "series_id string, train_end date, mode string, target_date date, predicted double",
        [("a", "2024-01-01", "multi", "2024-01-03", 10), ("a", "2024-01-01", "multi", "2024-01-04", 11)],
    )
    actuals = frame("series_id string, date date, y double", [("a", "2024-01-03", 12)])
    rows = bt.score_predictions(predictions, actuals).collect()
    assert [(r["step"], r["error"], r["abs_error"], r["squared_error"]) for r in rows] == [(2, -2.0, 2.0, 4.0)]


def test_compose_hybrid_switch_clamp_and_fallback(frame):
    schema = "series_id string, origin date, mode string, step int, target_date date, predicted double"
    days = [(s, f"2024-01-0{1 + s}") for s in range(1, 6)]  # origin Monday 2024-01-01, horizon 6
    it = [(k, "2024-01-01", "iterative", s, d, 100 + s) for k in "ab" for s, d in days]
    mu = [("a", "2024-01-01", "multi", s, d, 200 + s) for s, d in days]
    rows = frame(schema, it + mu + [("c", "2024-01-01", "single", 1, "2024-01-02", 5)])

    def run(switch):
        out = {}
        for r in fc.compose_hybrid(rows, switch).collect():
            out.setdefault(r["series_id"], {})[r["step"]] = r["predicted"]
        return {k: [v[s] for s in sorted(v)] for k, v in out.items()}

    assert run(2) == {"a": [101, 102, 203, 204, 205], "b": [101, 102, 103, 104, 105]}
    assert run(99)["a"] == [101, 102, 103, 104, 105]
    assert run(-5)["a"] == [101, 202, 203, 204, 205]
    assert run(None)["a"] == [101, 102, 103, 204, 205]
    own = frame("series_id string, switch int", [("a", 1)])
    assert run(own)["a"] == [101, 202, 203, 204, 205]


def test_hybrid_reads_its_rows_once(frame):
    schema = "series_id string, origin date, mode string, step int, target_date date, predicted double"
    plan = fc.compose_hybrid(frame(schema, [("a", "2024-01-01", "multi", 1, "2024-01-02", 1)]), 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_doubled_actuals_count_once_or_fail(frame):
    predictions = frame(
        "series_id string, train_end date, mode string, target_date date, predicted double",
        [("a", "2024-01-01", "multi", "2024-01-03", 10)],
    )
    actuals = frame("series_id string, date date, y double, at int", [("a", "2024-01-03", 12, 2), ("a", "2024-01-03", 99, 1)])
    assert [r["actual"] for r in bt.score_predictions(predictions, actuals, order="at").collect()] == [12]
    with pytest.raises(Exception, match="duplicate day"):
        bt.score_predictions(predictions, actuals).collect()


def test_latest_at_or_before(frame):
    rows = frame("series_id string, date date, v int", [("a", "2024-01-01", 1), ("a", "2024-01-05", 2), ("b", "2024-01-09", 3)])
    got = fc.latest_at_or_before(rows, "date", F.lit("2024-01-06").cast("date")).collect()
    assert [(r["series_id"], r["v"]) for r in got] == [("a", 2)]


@pytest.fixture(scope="module")
def two_series(daily):
    a = daily(80, value=lambda i: 1000.0 + 50 * (i % 7))
    b = daily(80, value=lambda i: 10.0 + (i % 7), series="b")
    return series.fill_gaps(a.unionByName(b))


def test_linear_learner_finds_the_weekly_pattern(two_series):
    one = learners.Learner("linear")
    got = paths(learners.forecast(two_series, {"iterative": one, "multi": one, "single": one}))
    for s in range(1, len(got[("a", "iterative")]) + 1):
        assert got[("a", "iterative")][s][1] == pytest.approx(1000 + 50 * ((79 + s) % 7), rel=1e-2)
        assert got[("b", "multi")][s][1] == pytest.approx(10 + (79 + s) % 7, rel=1e-2)
    assert got[("a", "single")][1][1] == pytest.approx(got[("a", "iterative")][1][1])


def plain_rows(filled, rank, steps, newest):
    """(features, labels) of a cutoff, day by day from the filled series."""
    marks = {(r["series_id"], r["date"]): r["cutoff_rank"] for r in bt.mark_cutoffs(filled, newest=newest, observed=~F.col("is_filled")).collect()}
    flags = {r["date"]: [float(r[c]) for c in CALENDAR_COLUMNS] for r in with_calendar(filled.select("date").distinct()).collect()}
    by_series = {}
    for r in sorted(filled.collect(), key=lambda r: r["date"]):
        by_series.setdefault(r["series_id"], []).append((r["date"], r["y"]))
    x, labels = [], []
    for name, days in by_series.items():
        end = max((d for d, _ in days if marks[name, d] == rank), default=None) if rank else days[-1][0]
        seen = [y for d, y in days if end is not None and d <= end]
        lo, hi = (min(seen), max(seen)) if seen else (0.0, 0.0)
        scale = [(y - lo) / (hi - lo) if hi > lo else 0.0 for y in seen]
        for i in range(len(seen)):
            for step in range(1, steps + 1):
                if i >= 20 + step:
                    x.append([scale[i - k - step + 1] for k in series.TARGET_LAGS] + flags[days[i][0]] + ([float(step)] if steps > 1 else []))
                    labels.append(scale[i])
    return np.array(x), np.array(labels)


@pytest.fixture(scope="module")
def uneven(daily):
    """Three series of noise: one with gaps, one constant at first, one too short for the last steps."""
    noise = np.random.default_rng(5).random((3, 90))
    return series.fill_gaps(
        daily(90, value=lambda i: 1e6 + 100 * noise[0][i], missing={40, 41, 80})
        .unionByName(daily(90, value=lambda i: 5.0 if i < 84 else noise[1][i], series="b"))
        .unionByName(daily(24, value=lambda i: noise[2][i], series="c"))
    )


def arrow_rows(frame, batch=10_000):
    table = frame.select(*learners.row_columns(["series_id"])).toArrow()
    return [learners.Rows.of(b) for b in table.to_batches(max_chunksize=batch)]


@pytest.mark.parametrize("steps", [1, 7])
def test_training_rows_are_those_up_to_the_cutoff(uneven, steps):
    frame = learners.learner_frame(uneven, newest=3)
    for rank in range(4):
        x, y = plain_rows(uneven, rank, steps, 3)
        got = [learners.labelled(rows, rank, steps) for rows in arrow_rows(frame, 50)]
        table = sorted(np.column_stack([np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])]).tolist())
        assert np.allclose(table, sorted(np.column_stack([x, y]).tolist()), atol=1e-12)


@pytest.mark.parametrize("batch", [7, 10_000])
def test_moments_of_segments_add_up(uneven, batch):
    """Rows multiplied out once give each cutoff's and step's sums, however they are cut into batches."""
    frame = learners.learner_frame(uneven, newest=4)
    found = {}
    for rows in arrow_rows(frame, batch):
        for k, m in learners.cut_moments(rows, [1, 7]).items():
            found[k] = found.get(k, 0.0) + m
    assert set(found) == {(rank, steps) for rank in range(5) for steps in (1, 7)}
    for (rank, steps), got in found.items():
        x, y = plain_rows(uneven, rank, steps, 4)
        wide = np.column_stack([x, np.ones(len(x)), y])
        assert np.allclose(got, wide.T @ wide, rtol=1e-9, atol=1e-8)


def test_metrics_of_an_empty_backtest(frame):
    empty = frame("train_end date, mode string, target_date date, step int, predicted double, actual double, error double, abs_error double, squared_error double", [])
    rows = ev.overall_metrics(empty).collect()
    assert [(r["mode"], r["count"], r["MAE"]) for r in rows] == [(m, 0, None) for m in fc.MODES]
    assert [r["bias"] for r in ev.weekday_bias(empty).collect()] == [0.0] * 7
    assert ev.global_bias_of_detail(empty).first()["bias"] == 0.0


def test_trend_backtest_follows_a_line(daily):
    seen = series.fill_gaps(daily(80, value=lambda i: 4.0 * i, missing={71, 74}))
    rows = bt.run_trend(seen).collect()
    assert rows and all(abs(r["error"]) < 1e-6 for r in rows)
    plain = bt.run(seen.where("not is_filled").select("series_id", "date", "y"), {"multi": models.seasonal_naive()}).collect()
    assert {(r["train_end"], r["target_date"]) for r in rows} == {(r["train_end"], r["target_date"]) for r in plain}


def test_documented_learners_in_all_modes(two_series):
    got = paths(learners.forecast(two_series, learners.FORECAST_LEARNERS))
    for mode in ("iterative", "multi", "single"):
        for s, (_, value) in got[("a", mode)].items():
            assert value == pytest.approx(1000 + 50 * ((79 + s) % 7), rel=0.05)


def test_lines_are_fitted_on_all_rows(uneven):
    frame = learners.learner_frame(uneven, newest=2)
    for (rank, mode), line in learners.fitted_models(frame.repartition(3), catalogue.LINEAR).items():
        x, y = plain_rows(uneven, rank, 7 if mode == "multi" else 1, 2)
        x = np.column_stack([x, np.ones(len(x))])
        want = np.linalg.solve(x.T @ x + 1e-6 * len(x) * np.eye(x.shape[1]), x.T @ y)
        assert np.allclose(line.weights, want, rtol=1e-6, atol=1e-9) and line.rows == len(x)
        assert line.training_error == pytest.approx(np.square(y - x @ want).mean(), abs=1e-9)
        assert line.constant_error == pytest.approx(y.var(), abs=1e-9)
        assert np.abs(line.residual_products).max() < 1e-4


def same_trees(a, b):
    return (
        a.base == b.base
        and all(np.array_equal(x, y) for x, y in zip(a.leaves, b.leaves, strict=True))
        and all(np.array_equal(x, y) for p, q in zip(a.splits, b.splits, strict=True) for s, t in zip(p, q) for x, y in zip(s, t))
    )


def test_trees_are_grown_on_all_rows(daily):
    """More rows than any sample there once was, and the same trees whatever the partitions."""
    noise = np.random.default_rng(1).random((4, 1500))
    rows = [daily(1500, "2018-01-01", lambda i, k=k: noise[k][i] + i % 7, f"s{k}") for k in range(4)]
    filled = series.fill_gaps(rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3]))
    few = {"iterative": learners.Learner(rounds=5), "multi": learners.Learner(rounds=3)}
    frame = learners.learner_frame(filled, newest=1)
    one, two = (learners.fitted_models(f, few) for f in (frame, frame.repartition(7)))
    assert set(one) == {(0, "iterative"), (1, "iterative"), (0, "multi"), (1, "multi")}
    assert all(same_trees(one[k], two[k]) for k in one)
    assert one[0, "iterative"].rows == 4 * (1500 - 21) and one[0, "multi"].rows == 4 * sum(1500 - 20 - s for s in range(1, 8))
    assert all(m.training_error < m.constant_error for m in one.values())


def test_tasks_that_share_a_model_grow_the_same_trees(uneven):
    """A barrier stage: the rows of each model are in several tasks, which exchange histograms."""
    frame = learners.learner_frame(uneven, newest=1)
    few = {"iterative": learners.Learner(rounds=2, depth=2)}
    alone, shared = learners.fitted_models(frame, few), learners.fitted_models(frame, few, slots=4, task_rows=60)
    assert set(alone) == set(shared) == {(0, "iterative"), (1, "iterative")}
    assert all(same_trees(alone[k], shared[k]) for k in alone)


@pytest.mark.parametrize("parts", [2, 5])
def test_fits_in_step(parts):
    """Threads in place of tasks; one has no rows, one takes part in a single model."""
    rng = np.random.default_rng(parts)
    x, y = np.column_stack([rng.random((800, 4)), rng.integers(0, 2, (800, 3))]), rng.random(800)
    home, met, box, found = rng.integers(0, parts - 1, 800), threading.Barrier(parts), [""] * parts, [{}] * parts

    def task(i):
        def gather(message):
            box[i] = message
            met.wait()
            said = list(box)
            met.wait()
            return said

        fits = {"a": Trees(6, 0.1, 4, 5, 0.8, 1).growing(x[home == i], y[home == i])}
        if i < parts - 1:
            fits["b"] = Trees(3, 0.1, 3, 5, 1.0, 2).growing(x[home == i, :2], y[home == i])
        found[i] = in_step(fits, gather)

    threads = [threading.Thread(target=task, args=(i,)) for i in range(parts)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    whole = {"a": Trees(6, 0.1, 4, 5, 0.8, 1).fit(x, y), "b": Trees(3, 0.1, 3, 5, 1.0, 2).fit(x[:, :2], y)}
    assert all(same_trees(m, whole[k]) for own in found for k, m in own.items())
    assert [set(own) for own in found] == [{"a", "b"}] * (parts - 1) + [{"a"}]


def test_histograms_of_smaller_children_are_enough():
    """Each split is the best of its node by plain sums over its rows."""
    rng = np.random.default_rng(3)
    x, y = np.column_stack([rng.random((500, 3)), rng.integers(0, 2, (500, 2))]), rng.random(500)
    m = Trees(2, 0.5, 3, 20, 1.0, 0).fit(x, y)
    bins, left = m._binned(x), y - y.mean()
    for levels, value in zip(m.splits, m.leaves):
        node = np.zeros(500, int)
        for feature, bound in levels:
            for k in range(len(feature)):
                own = node == k
                best, n = 0.0, own.sum()
                for j in range(5):
                    for b in range(bins[j].max()):
                        low = own & (bins[j] <= b)
                        if low.sum() >= 20 and n - low.sum() >= 20:
                            high = own & ~low
                            best = max(best, left[low].sum() ** 2 / low.sum() + left[high].sum() ** 2 / high.sum() - left[own].sum() ** 2 / n)
                if best:
                    low = own & (bins[feature[k]] <= bound[k])
                    high = own & ~low
                    assert left[low].sum() ** 2 / low.sum() + left[high].sum() ** 2 / high.sum() - left[own].sum() ** 2 / n == pytest.approx(best)
                else:
                    assert bound[k] >= 64 or not n
            node = node * 2 + (bins[feature[node], np.arange(500)] > bound[node])
        left = left - value[node]
        for k in range(8):
            assert abs(left[node == k].mean() - value[k]) < 1e-6 if (node == k).any() else True


def test_shares_of_models():
    one, two = learners.Learner(rounds=10), learners.Learner(rounds=100)
    tasks = learners.dealt([(0, 1, one), (0, 7, two), (1, 1, one)], rows=1000, slots=4, task_rows=2500)
    shares = [s for own in tasks for s in own]
    assert sorted((s.model, s.part, s.parts) for s in shares) == [(0, 0, 1), (1, 0, 3), (1, 1, 3), (1, 2, 3), (2, 0, 1)]
    assert all(len({s.model for s in own}) == len(own) for own in tasks) and len(tasks) == 4


def test_null_value_in_training_fails(frame, daily):
    broken = series.fill_gaps(daily(60)).withColumn("y", F.when(F.col("date") == "2024-02-20", F.lit(float("nan"))).otherwise(F.col("y")))
    with pytest.raises(Exception, match="null or infinite"):
        learners.forecast(broken, {"iterative": learners.Learner(rounds=2)}).collect()
    with pytest.raises(Exception, match="null or infinite"):
        learners.forecast(broken, {"iterative": learners.Learner("linear")}).collect()


def test_near_means_the_values_up_to_the_cutoff(daily, frame):
    seen = series.fill_gaps(daily(40, value=lambda i: i % 7 if i < 30 else 1000))
    rows = frame(
        "series_id string, train_end date, predicted double",
        [("a", "2024-01-20", 6.0), ("a", "2024-01-20", 500.0), ("a", "2024-01-20", 8.0), ("a", "2024-02-05", 500.0), ("a", "2024-02-05", None)],
    )

    def near(slack):
        return sorted(str(r["is_near"]) for r in catalogue._plausible(rows, seen, "train_end", slack).collect())

    assert near(0.0) == ["False", "False", "None", "True", "True"]
    assert near(0.5) == ["False", "None", "True", "True", "True"]


@pytest.mark.parametrize("settings", [catalogue.LINEAR, learners.BACKTEST_LEARNERS], ids=["linear", "gbt"])
def test_learners_beat_a_constant(two_series, settings):
    rows = learners.backtest(two_series, settings, newest=3).collect()
    for name in ("a", "b"):
        for mode in settings:
            own = [r for r in rows if (r["series_id"], r["mode"]) == (name, mode)]
            mean = 1150.0 if name == "a" else 13.0
            assert own and sum(r["abs_error"] for r in own) < 0.5 * sum(abs(mean - r["actual"]) for r in own)


def test_trees_follow_a_step_and_a_product():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = np.where(x[:, 0] > 0.4, 2.0, 0.0) + x[:, 1] * x[:, 2]
    model = Trees(200, 0.05, 4, 5, 1.0, 1).fit(x, y)
    assert np.abs(model.predict(x[:500]) - y[:500]).mean() < 0.1
    flat = Trees(10, 0.1, 3, 5, 1.0, 1).fit(np.ones((20, 2)), np.arange(20.0))
    assert np.allclose(flat.predict(np.ones((3, 2))), 9.5)
