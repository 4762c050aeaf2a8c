"""Pooled learned forecasts: one model a mode and cutoff over all series, each scaled by its own training range.

Every model is fitted to all its labelled rows. Lines come from moment matrices that each task
takes over its rows, once, whatever the number of cutoffs and steps. Trees grow where their rows
are: a model whose rows fit a task grows there, one with more grows in several tasks of a barrier
stage that exchange histograms, level by level. The driver does nothing a round.
Values differ from any other tree learner's; rows, steps and dates do not.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidecast.functions.dates import days_to_sunday
from tidecast.operators.backtest import DETAIL_COLUMNS, MAX_STEPS, mark_cutoffs, with_errors
from tidecast.operators.boosting import Fit, Line, Trees, alone, in_step
from tidecast.operators.calendar import CALENDAR_COLUMNS, calendar_values
from tidecast.operators.forecast import HISTORY, path_rows
from tidecast.operators.models import scaled, unscaled
from tidecast.operators.series import KEYS, TARGET_LAGS
from tidecast.session import fresh_folder

# Executors need no copy of the package for the functions that run there.
cloudpickle.register_pickle_by_value(sys.modules[Trees.__module__])
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a model that one task grows trees on; a model with more is shared out, and its tasks exchange histograms.
TASK_ROWS = 2_000_000
#: Tasks that share a model at most: every one of them gets what every other one sends.
MOST_TASKS = 64
LAGS = HISTORY + MAX_STEPS - 1


@dataclass(frozen=True)
class Learner:
    """Settings of a pooled model; the defaults are the documented ones. Lines have no use for most of them."""

    kind: str = "gbt"
    rounds: int = 300
    step_size: float = 0.05
    depth: int = 5
    min_rows: int = 5
    feature_share: float = 0.8
    seed: int = 42

    def estimator(self) -> Trees | Line:
        if self.kind == "linear":
            return Line()
        return Trees(self.rounds, self.step_size, self.depth, self.min_rows, self.feature_share, self.seed)


# Settings of the three modes in a backtest and in a forecast.
BACKTEST_LEARNERS = {
    "single": Learner(rounds=100, min_rows=20, feature_share=1.0),
    "multi": Learner(rounds=300),
    "iterative": Learner(rounds=300),
}
FORECAST_LEARNERS = {
    "single": Learner(rounds=300),
    "multi": Learner(rounds=400),
    "iterative": Learner(rounds=300),
}


def learner_frame(filled: DataFrame, keys: Sequence[str] = KEYS, warmup: int = 30, newest: int = 10) -> DataFrame:
    """Training rows with every lag any step needs, running bounds, cutoffs and the values ahead.

    ``cutoffs`` is the series' cutoff list on each row, so training rows up to a
    cutoff are a filter and not a join. All columns are windows of one exchange.
    """
    whole = Window.partitionBy(*keys)
    order = whole.orderBy("date")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    seen = F.when(~F.col("is_filled"), F.col("y"))
    frame = mark_cutoffs(filled, keys, warmup, newest, ~F.col("is_filled")).select(
        *keys,
        "date",
        "y",
        "cutoff_rank",
        F.max("date").over(whole).alias("last_date"),
        F.min("y").over(upto).alias("lo"),
        F.max("y").over(upto).alias("hi"),
        *[F.lag("y", k).over(order).alias(f"lag_{k}") for k in range(1, HISTORY + MAX_STEPS)],
        F.when(
            F.col("cutoff_rank").isNotNull(),
            F.array(*[F.lead(seen, k).over(order) for k in range(1, MAX_STEPS + 1)]),
        ).alias("ahead"),
    )
    # At most ``newest`` entries per series.
    entry = F.when(F.col("cutoff_rank").isNotNull(), F.struct("cutoff_rank", "date", "lo", "hi"))
    last = F.when(F.col("date") == F.col("last_date"), F.struct(F.lit(0).alias("cutoff_rank"), "date", "lo", "hi"))
    return (
        frame.withColumn("_cuts", F.collect_list(entry).over(whole))
        .withColumn("_last", F.max(last).over(whole))
        .withColumn("cutoffs", F.array_sort(F.concat(F.array("_last"), "_cuts")))
        .drop("_cuts", "_last")
    )


def calendar_array(day: Column) -> Column:
    return F.array(*[c.cast("double") for c in calendar_values(day)])


def origin_rows(frame: DataFrame, forecast: bool, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per series and cutoff (``forecast``: the last day), with its scaled history and the calendar of the days ahead."""
    here = F.col("date") == F.col("last_date") if forecast else F.col("cutoff_rank").isNotNull()
    past = [F.col(f"lag_{k}") for k in range(HISTORY - 1, 0, -1)] + [F.col("y")]
    return frame.where(here & F.col(f"lag_{HISTORY - 1}").isNotNull()).select(
        *keys,
        (F.lit(0) if forecast else F.col("cutoff_rank")).alias("rank"),
        F.col("date").alias("origin"),
        days_to_sunday(F.col("date")).alias("horizon"),
        "lo",
        "hi",
        "ahead",
        F.flatten(F.transform(F.sequence(F.lit(1), F.lit(MAX_STEPS)), lambda step: calendar_array(F.date_add("date", step)))).alias("calendars"),
        F.array(*[scaled(p, F.col("lo"), F.col("hi")) for p in past]).alias("hist"),
    )


def _steps(mode: str) -> int:
    return MAX_STEPS if mode == "multi" else 1


@dataclass
class Rows:
    """Training rows of many series as arrays; the cutoffs are those of the row's series, oldest first."""

    series: np.ndarray
    day: np.ndarray
    y: np.ndarray
    lags: np.ndarray
    calendar: np.ndarray
    cuts: list[list[dict]]

    @staticmethod
    def of(batch: pa.RecordBatch, first: int = 0) -> Rows:
        series, day, y, lags, calendar, cuts = batch.columns[first : first + 6]
        n = batch.num_rows
        values = y.to_numpy(zero_copy_only=False).astype(float)
        if not np.isfinite(values).all():
            raise ValueError("a training row has a null or infinite value")
        return Rows(
            series.to_numpy(zero_copy_only=False),
            day.to_numpy(zero_copy_only=False),
            values,
            lags.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1),
            calendar.flatten().to_numpy(zero_copy_only=False).reshape(n, -1),
            cuts,
        )

    def known(self) -> np.ndarray:
        """For how many steps ahead a row has all lags: a step further asks for one day more."""
        return np.clip((~np.isnan(self.lags)).sum(1) - HISTORY + 1, 0, MAX_STEPS)

    def by_series(self) -> Iterator[tuple[np.ndarray, list[dict]]]:
        """(rows, cutoffs) of each series."""
        order = np.argsort(self.series, kind="stable")
        starts = np.flatnonzero(np.append(True, self.series[order][1:] != self.series[order][:-1])) if len(order) else []
        for own in np.split(order, starts[1:]):
            if len(own):
                yield own, self.cuts[int(own[0])].as_py()


def row_columns(keys: Sequence[str]) -> list[Column]:
    """The columns that ``Rows.of`` reads, in their order; lags not yet known are null."""
    cut = F.transform("cutoffs", lambda c: F.struct(F.unix_date(c["date"]).alias("day"), c["cutoff_rank"].alias("rank"), c["lo"], c["hi"]))
    return [
        F.xxhash64(*keys).alias("series"),
        F.unix_date("date").alias("day"),
        F.col("y").cast("double").alias("y"),
        F.array(*[F.col(f"lag_{k}").cast("double") for k in range(1, LAGS + 1)]).alias("lags"),
        F.array(*[c.cast("tinyint") for c in calendar_values(F.col("date"))]).alias("calendar"),
        F.array_sort(cut).alias("cuts"),
    ]


def _lags_of(step: int) -> list[int]:
    """The columns of ``lags`` that are the target lags of a row foretold ``step`` days ahead."""
    return [k + step - 2 for k in TARGET_LAGS]


def cut_moments(rows: Rows, spans: Iterable[int]) -> dict[tuple[int, int], np.ndarray]:
    """Sums of products of (features, 1, label) by (rank, steps), scaled by each cut's range.

    A row is multiplied out once, with all its lags in the units of the series' newest range.
    Its product counts for the segment between two cutoffs it lies in; sums of segments up to a
    cutoff, picked for each step and mapped to the cut's range, are what its rows would
    have summed to one by one, since scaling is affine.
    """
    found: dict[tuple[int, int], np.ndarray] = {}
    days = rows.calendar.shape[1]
    label, one = LAGS + days + 1, LAGS + days
    moving = [*range(LAGS), label]  # scaled by the range
    known = rows.known()
    for own, cuts in rows.by_series():
        if not cuts:
            continue
        ends = np.array([c["day"] for c in cuts])
        low, high = cuts[-1]["lo"], cuts[-1]["hi"]
        width = high - low if high > low else 1.0
        wide = np.column_stack([(np.nan_to_num(rows.lags[own], nan=low) - low) / width, rows.calendar[own], np.ones(len(own)), (rows.y[own] - low) / width])
        segment = np.searchsorted(ends, rows.day[own], "left")
        upto = np.zeros((MAX_STEPS + 1, label + 1, label + 1))  # by the steps that a row counts for
        for s, cut in enumerate(cuts):
            here = np.flatnonzero(segment == s)
            for k in np.unique(known[own][here]):
                part = wide[here[known[own][here] == k]]
                upto[k] += part.T @ part
            scale = np.eye(label + 1)
            room = cut["hi"] - cut["lo"]
            scale[moving, moving] = width / room if room > 0 else 0.0
            scale[moving, one] = (low - cut["lo"]) / room if room > 0 else 0.0
            for steps in spans:
                total = 0.0
                for step in range(1, steps + 1):
                    pick = np.array([*_lags_of(step), *range(LAGS, LAGS + days), *([one] if steps > 1 else []), one, label])
                    mapped = scale[pick]
                    if steps > 1:
                        mapped[-3] *= step  # the step is the last feature
                    total = total + mapped @ upto[step:].sum(0) @ mapped.T
                key = (cut["rank"], steps)
                found[key] = found.get(key, 0.0) + total
    return found


def _summed_lines(frame: DataFrame, spans: Sequence[int], keys: Sequence[str]) -> dict[tuple[int, int], Line]:
    """Least squares by (rank, steps) over all labelled rows; a task hands on one matrix of sums each."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, matrix in cut_moments(Rows.of(batch), spans).items():
                held[k] = held.get(k, 0.0) + matrix
        ranks, steps = [k[0] for k in sorted(held)], [k[1] for k in sorted(held)]
        cells = [held[k].ravel().tolist() for k in sorted(held)]
        columns = [pa.array(ranks, pa.int32()), pa.array(steps, pa.int32()), pa.array(cells, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["rank", "steps", "sums"])

    summed = frame.select(*row_columns(keys)).mapInArrow(sums, "rank int, steps int, sums array<double>")
    cells = summed.select("rank", "steps", F.posexplode("sums").alias("at", "value"))
    # sorted before they are added: the order that a shuffle delivers must not matter
    total = F.aggregate(F.array_sort(F.collect_list("value")), F.lit(0.0), lambda a, v: a + v)
    added = cells.groupBy("rank", "steps", "at").agg(total.alias("value")).groupBy("rank", "steps")
    added = added.agg(F.array_sort(F.collect_list(F.struct("at", "value")))["value"].alias("sums")).collect()
    lines = {}
    for r in added:
        width = round(len(r["sums"]) ** 0.5)
        matrix = np.array(r["sums"]).reshape(width, width)
        if matrix[-2, -2] != 0:  # there are rows
            lines[r["rank"], r["steps"]] = Line().solve(matrix)
    return lines


def labelled(rows: Rows, rank: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of every row and step that count for a cutoff, scaled by its range."""
    low, high, end = (np.full(len(rows.y), v) for v in (np.nan, np.nan, -(2.0**62)))
    for own, cuts in rows.by_series():
        for cut in cuts:
            if cut["rank"] == rank:
                low[own], high[own], end[own] = cut["lo"], cut["hi"], cut["day"]
    room = high - low

    def scale(values: np.ndarray, own: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            by = (values.T - low[own]) / room[own]
        return np.where(room[own] > 0, by, 0.0).T

    known = rows.known()
    features, labels = [], []
    for step in range(1, steps + 1):
        own = np.flatnonzero((rows.day <= end) & (known >= step))
        wide = [scale(rows.lags[own][:, _lags_of(step)], own), rows.calendar[own]]
        features.append(np.column_stack(wide + ([np.full(len(own), float(step))] if steps > 1 else [])))
        labels.append(scale(rows.y[own], own))
    return np.concatenate(features), np.concatenate(labels)


@dataclass(frozen=True)
class Share:
    """The part of a model's rows that one task has: those whose hash leaves ``part`` over ``parts``."""

    model: int
    part: int
    parts: int


def dealt(models: Sequence[tuple[int, int, Learner]], rows: int, slots: int, task_rows: int = TASK_ROWS) -> list[list[Share]]:
    """Shares by task: models in as many parts as their rows need, the longest work first to the task with least."""
    shares, work = [], {}
    for model, (_, steps, learner) in enumerate(models):
        parts = min(-(-rows * steps // task_rows), MOST_TASKS, slots) or 1
        work[model] = steps * learner.rounds / parts
        shares += [Share(model, k, parts) for k in range(parts)]
    tasks: list[list[Share]] = [[] for _ in range(max(1, min(slots, len(shares))))]
    load = [0.0] * len(tasks)
    for share in sorted(shares, key=lambda s: -work[s.model]):
        # two parts of a model in one task would be one part
        free = [t for t in range(len(tasks)) if all(s.model != share.model for s in tasks[t])]
        best = min(free, key=lambda t: load[t])
        tasks[best].append(share)
        load[best] += work[share.model]
    return tasks


def _grown_trees(
    frame: DataFrame, models: Sequence[tuple[int, int, Learner]], keys: Sequence[str], slots: int | None, task_rows: int
) -> dict[tuple[int, int, Learner], Trees]:
    """Trees over all labelled rows. Each row goes once to each task that has a share with it, unexpanded."""
    slots = slots or frame.sparkSession.sparkContext.defaultParallelism
    tasks = dealt(models, frame.count(), slots, task_rows)
    together = any(s.parts > 1 for own in tasks for s in own)
    draw = F.xxhash64(*keys, "date")
    homes: dict[int, list[list[int]]] = {}  # parts -> tasks by part
    for t, own in enumerate(tasks):
        for s in own:
            by_part = homes.setdefault(s.parts, [[] for _ in range(s.parts)])
            if t not in by_part[s.part]:
                by_part[s.part].append(t)
    goals = [F.element_at(F.array(*[F.array(*map(F.lit, g)) for g in by_part]), (F.pmod(draw, F.lit(n)) + 1).cast("int")) for n, by_part in homes.items()]
    sent = frame.where(F.size("cutoffs") > 0).select(F.explode(F.array_distinct(F.concat(*goals))).alias("task"), draw.alias("draw"), *row_columns(keys))
    sent = sent.repartitionById(len(tasks), F.col("task"))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get() if together else TaskContext.get()
        held = [b for b in batches if b.num_rows]
        own = tasks[context.partitionId()]
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if held else None

        def fit(share: Share) -> Fit:
            rank, steps, learner = models[share.model]
            if whole is None:
                x, y = np.zeros((0, len(TARGET_LAGS) + len(CALENDAR_COLUMNS) + (steps > 1))), np.zeros(0)
            else:
                mine = whole.filter(pa.array(whole.column(1).to_numpy() % share.parts == share.part))
                x, y = labelled(Rows.of(mine, 2), rank, steps)
            return learner.estimator().growing(x, y)

        grown = in_step({s.model: fit(s) for s in own if s.parts > 1}, context.allGather) if together else {}
        for s in own:
            trees = alone(fit(s)) if s.parts == 1 else grown[s.model] if s.part == 0 else None
            if trees is not None:
                yield pa.RecordBatch.from_arrays([pa.array([s.model], pa.int32()), pa.array([pickle.dumps(vars(trees))], pa.binary())], names=["model", "state"])

    found = {}
    for r in sent.mapInArrow(grow, "model int, state binary", barrier=together).collect():
        found[models[r["model"]]] = trees = Trees.__new__(Trees)
        vars(trees).update(pickle.loads(r["state"]))
    return found


def fitted_models(
    frame: DataFrame, learners: Mapping[str, Learner], keys: Sequence[str] = KEYS, slots: int | None = None, task_rows: int = TASK_ROWS
) -> dict[tuple[int, str], Trees | Line]:
    """Models by (rank, mode), each fitted to all its labelled rows.

    ``slots`` bounds the tasks that grow trees, by default the cores of the cluster: tasks that
    share a model must run at the same time, which a cluster with dynamic allocation can't
    promise. A model of more than ``task_rows`` rows is shared. What reaches the driver is
    bounded by the number of cutoffs and modes and the settings.
    """
    models: dict[tuple[int, str], Trees | Line] = {}
    lines = sorted({_steps(mode) for mode, learner in learners.items() if learner.kind == "linear"})
    if lines:
        for (rank, steps), line in _summed_lines(frame, lines, keys).items():
            models |= {(rank, m): line for m, learner in learners.items() if learner.kind == "linear" and _steps(m) == steps}
    wanted = {(_steps(mode), learner) for mode, learner in learners.items() if learner.kind != "linear"}
    if wanted:
        ranks = [r[0] for r in frame.select(F.explode("cutoffs.cutoff_rank")).distinct().collect()]
        order = sorted(wanted, key=lambda w: (w[0], repr(w[1])))
        for (rank, steps, learner), trees in _grown_trees(frame, [(r, *w) for r in sorted(ranks) for w in order], keys, slots, task_rows).items():
            models |= {(rank, m): trees for m, own in learners.items() if own == learner and _steps(m) == steps}
    return models


def training_report(spark: SparkSession, models: Mapping[tuple[int, str], Trees | Line]) -> DataFrame:
    """(rank, mode, n_rows, constant_error, training_error, residual_product): how each fit does on its own rows.

    Errors are mean squares in units of the cuts' ranges, the constant's that of the labels'
    mean; for lines the last column is the largest mean product of residual and feature, which
    least squares brings to 0.
    """
    rows = []
    for (rank, mode), m in sorted(models.items()):
        product = float(np.abs(m.residual_products).max()) if isinstance(m, Line) else None
        rows.append((rank, mode, m.rows, float(m.constant_error), float(m.training_error), product))
    return spark.createDataFrame(rows, "rank int, mode string, n_rows long, constant_error double, training_error double, residual_product double")


def predicted_paths(origins: DataFrame, models: Mapping[tuple[int, str], Trees | Line]) -> DataFrame:
    """Add ``runs``, an array of (mode, path): scaled predictions of the steps ahead.

    The iterated path appends each prediction to the history of the next step; the direct
    one has the step as a feature; the single one has one step.
    """
    shared = origins.sparkSession.sparkContext.broadcast({k: (isinstance(m, Line), vars(m)) for k, m in models.items()})
    kind = T.ArrayType(T.StructType([T.StructField("mode", T.StringType()), T.StructField("path", T.ArrayType(T.DoubleType()))]))
    arrow = pa.list_(pa.struct([("mode", pa.string()), ("path", pa.list_(pa.float64()))]))
    at = {c: origins.columns.index(c) for c in ("rank", "calendars", "hist")}
    lags, days = np.array(TARGET_LAGS), len(CALENDAR_COLUMNS)

    def path(mode: str, model, hist: np.ndarray, calendars: np.ndarray) -> np.ndarray:
        out = []
        for step in range(1 if mode == "single" else MAX_STEPS):
            seen = hist[:, hist.shape[1] - lags]
            wide = [seen, calendars[:, step]] + ([np.full((len(hist), 1), step + 1.0)] if mode == "multi" else [])
            out.append(model.predict(np.concatenate(wide, 1)))
            if mode == "iterative":
                hist = np.concatenate([hist[:, 1:], out[-1][:, None]], 1)
        return np.stack(out, 1)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {}
        for key, (is_line, values) in shared.value.items():
            own[key] = Line() if is_line else Trees.__new__(Trees)
            vars(own[key]).update(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            rank = np.array(batch.column(at["rank"]).to_pylist())
            hist = np.array(batch.column(at["hist"]).to_pylist(), float)
            calendars = np.array(batch.column(at["calendars"]).to_pylist(), float).reshape(len(rank), MAX_STEPS, days)
            runs: list[list[dict]] = [[] for _ in rank]
            for (r, mode), model in sorted(own.items()):
                rows = np.flatnonzero(rank == r)
                if len(rows):
                    for i, p in zip(rows.tolist(), path(mode, model, hist[rows], calendars[rows]).tolist()):
                        runs[i].append({"mode": mode, "path": p})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs, arrow)], names=[*batch.schema.names, "runs"])

    return origins.mapInArrow(predict, T.StructType([*origins.schema.fields, T.StructField("runs", kind)]))


def _runs(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(keep, mode, path): unscaled predictions to the horizon."""
    flat = rows.select(*keep, "horizon", "lo", "hi", F.explode("runs").alias("_run")).select("*", "_run.mode", F.col("_run.path").alias("_path"))
    values = F.slice("_path", F.lit(1), F.col("horizon"))
    return flat.select(*keep, "mode", F.transform(values, lambda p: unscaled(p, F.col("lo"), F.col("hi"))).alias("path"))


def _fitted(
    filled: DataFrame, learners: Mapping[str, Learner], keys: Sequence[str], warmup: int, newest: int | None
) -> tuple[DataFrame, dict[tuple[int, str], Trees | Line]]:
    """The frame, written once to the shared folder, and the models of the ``newest`` cutoffs, or of the last day if None."""
    spark = filled.sparkSession
    path = fresh_folder(spark, "learner-frame")
    learner_frame(filled, keys, warmup, newest or 1).write.parquet(path)
    frame = spark.read.parquet(path)
    cuts = F.filter("cutoffs", lambda c: (c["cutoff_rank"] > 0) == F.lit(newest is not None))
    return frame, fitted_models(frame.withColumn("cutoffs", cuts), learners, keys)


def forecast(filled: DataFrame, learners: Mapping[str, Learner], keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, origin, mode, step, target_date, predicted) to each series' coming Sunday."""
    frame, models = _fitted(filled, learners, keys, 30, None)
    rows = _runs(predicted_paths(origin_rows(frame, True, keys), models), [*keys, "origin"])
    return path_rows(rows, F.col("path"), [*keys, "origin", "mode"])


def training(
    filled: DataFrame, learners: Mapping[str, Learner], keys: Sequence[str] = KEYS, warmup: int = 30, newest: int | None = None
) -> DataFrame:
    """``training_report`` of the models that ``forecast``, or with ``newest`` cutoffs ``backtest``, would use."""
    return training_report(filled.sparkSession, _fitted(filled, learners, keys, warmup, newest)[1])


def backtest(
    filled: DataFrame, learners: Mapping[str, Learner], keys: Sequence[str] = KEYS, warmup: int = 30, newest: int = 10
) -> DataFrame:
    """Backtest detail rows; the r-th fit trains every series on its own rows up to its r-th newest cutoff."""
    frame, models = _fitted(filled, learners, keys, warmup, newest)
    rows = _runs(predicted_paths(origin_rows(frame, False, keys), models), [*keys, "origin", "ahead"])
    flat = rows.select(*keys, F.col("origin").alias("train_end"), "mode", "ahead", F.posexplode("path").alias("_pos", "predicted"))
    out = flat.select(
        *keys,
        "train_end",
        "mode",
        F.date_add("train_end", F.col("_pos") + 1).alias("target_date"),
        (F.col("_pos") + 1).alias("step"),
        "predicted",
        F.get("ahead", F.col("_pos")).alias("actual"),
    ).where(F.col("actual").isNotNull())
    return with_errors(out).select(*keys, *DETAIL_COLUMNS)
