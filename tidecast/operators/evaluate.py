"""Error metrics, hybrid switch sweep, bias calibration and switch choice.

All functions take backtest detail rows and optional grouping ``keys``; without
keys they work over the whole table. Aggregates combine map-side, and every
sweep runs over sums per step, never over copies of the detail rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidecast.functions.dates import weekday
from tidecast.operators.forecast import MODES
from tidecast.operators.ranking import counted_values, quantiles_of_counts

PAIR = ("iterative", "multi")


def overall_metrics(detail: DataFrame, keys: Sequence[str] = (), modes: Sequence[str] = MODES) -> DataFrame:
    """count, MAE, MSE, MeanError and MSAE (the mean signed error) of each mode found.

    Each of ``modes`` that is absent has a row with count 0; other modes are measured too.
    Rows collapse to one per key and mode before the absent ones are added.
    """
    sums = detail.groupBy(*keys, "mode").agg(
        F.count("error").alias("count"),
        F.avg("abs_error").alias("MAE"),
        F.avg("squared_error").alias("MSE"),
        F.avg("error").alias("MeanError"),
    )
    return all_modes(sums, keys, modes)


def all_modes(sums: DataFrame, keys: Sequence[str], modes: Sequence[str]) -> DataFrame:
    """The metrics of each key and mode, with a row of count 0 for each of ``modes`` that a key lacks."""
    found = F.collect_list(F.struct("mode", "count", "MAE", "MSE", "MeanError"))
    listed = F.array(*[F.lit(m) for m in modes])
    none = F.lit(None).cast("double")
    absent = F.transform(
        F.array_except(listed, F.transform("_found", lambda r: r["mode"])),
        lambda m: F.struct(m.alias("mode"), F.lit(0).cast("long").alias("count"), none.alias("MAE"), none.alias("MSE"), none.alias("MeanError")),
    )
    summary = sums.groupBy(*keys).agg(found.alias("_found")).select(*keys, F.explode(F.concat("_found", absent)).alias("_m"))
    return summary.select(*keys, "_m.*", F.col("_m.MeanError").alias("MSAE"))


def horizon_metrics(detail: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return detail.groupBy(*keys, "mode", "step").agg(
        F.count("error").alias("count"),
        F.avg("abs_error").alias("MAE"),
        F.avg("squared_error").alias("MSE"),
        F.avg("error").alias("MeanError"),
    )


def pivot_modes(detail: DataFrame, keys: Sequence[str] = (), modes: Sequence[str] = MODES) -> DataFrame:
    """One row per (cutoff, target, step, actual) with ``<mode>_predicted`` and ``<mode>_error``.

    The mode list is given, so no job looks for it; duplicates are averaged.
    """
    return (
        detail.groupBy(*keys, "train_end", "target_date", "step", "actual")
        .pivot("mode", list(modes))
        .agg(F.avg("predicted").alias("predicted"), F.avg("error").alias("error"))
    )


def global_bias(pivoted: DataFrame, keys: Sequence[str] = (), mode: str = "iterative") -> DataFrame:
    """(keys, bias): the negative mean error of a mode, 0 where it has no rows."""
    mean_error = F.avg(F.col(f"{mode}_predicted") - F.col("actual"))
    return pivoted.groupBy(*keys).agg(F.coalesce(-mean_error, F.lit(0.0)).alias("bias"))


def global_bias_of_detail(detail: DataFrame, keys: Sequence[str] = (), mode: str = "iterative") -> DataFrame:
    own = F.when(F.lower("mode") == mode, F.col("predicted") - F.col("actual"))
    return detail.groupBy(*keys).agg(F.coalesce(-F.avg(own), F.lit(0.0)).alias("bias"))


def join_on_keys(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on the keys. Without keys the right side is one aggregate row, safe to broadcast."""
    if keys:
        return df.join(small, [*keys], "left")
    one = F.lit(1)
    return df.withColumn("_one", one).join(F.broadcast(small.withColumn("_one", one)), "_one", "left").drop("_one")


def switch_sweep(
    pivoted: DataFrame, keys: Sequence[str] = (), bias: DataFrame | None = None, switches: int = 7
) -> DataFrame:
    """Hybrid MAE, MSE and mean error for switch 1..n: iterative (plus bias) to the switch, multi after it.

    Errors are summed per step first; the switches then expand a handful of sums
    per key instead of the rows.
    """
    if bias is None:
        pivoted = pivoted.withColumn("bias", F.lit(0.0))
    else:
        pivoted = join_on_keys(pivoted, bias, keys)
    it = F.col("iterative_predicted") + F.coalesce(F.col("bias"), F.lit(0.0)) - F.col("actual")
    mu = F.col("multi_predicted") - F.col("actual")
    per_step = (
        pivoted.select(*keys, "step", it.alias("_it"), mu.alias("_mu"))
        .groupBy(*keys, "step")
        .agg(
            *[
                agg.alias(f"{name}{side}")
                for side in ("_it", "_mu")
                for name, agg in (
                    ("n", F.count(side)),
                    ("abs", F.sum(F.abs(F.col(side)))),
                    ("sq", F.sum(F.col(side) * F.col(side))),
                    ("sum", F.sum(side)),
                )
            ]
        )
    )
    return sweep_of_steps(per_step, keys, switches)


def sweep_of_steps(per_step: DataFrame, keys: Sequence[str], switches: int) -> DataFrame:
    """The sweep from the sums of both modes by step."""
    per_step = per_step.withColumn("switch", F.explode(F.sequence(F.lit(1), F.lit(switches))))

    def chosen(name: str) -> Column:
        return F.sum(F.when(F.col("step") <= F.col("switch"), F.col(f"{name}_it")).otherwise(F.col(f"{name}_mu")))

    return per_step.groupBy(*keys, "switch").agg(
        F.try_divide(chosen("abs"), chosen("n")).alias("MAE"),
        F.try_divide(chosen("sq"), chosen("n")).alias("MSE"),
        F.try_divide(chosen("sum"), chosen("n")).alias("MeanError"),
    )


def weekday_bias(detail: DataFrame, keys: Sequence[str] = (), mode: str = "iterative") -> DataFrame:
    """(keys, weekday, bias): negative mean error by target weekday, all seven weekdays, 0 where none."""
    error = F.col("predicted") - F.col("actual")
    own = F.lower("mode") == mode
    means = [
        F.avg(F.when(own & (weekday(F.col("target_date")) == k), error)).alias(f"_{k}") for k in range(7)
    ]
    return (
        detail.groupBy(*keys)
        .agg(*means)
        .select(*keys, F.posexplode(F.array(*[f"_{k}" for k in range(7)])).alias("weekday", "_e"))
        .select(*keys, "weekday", F.coalesce(-F.col("_e"), F.lit(0.0)).alias("bias"))
    )


def weekday_bias_before(detail: DataFrame, keys: Sequence[str], mode: str = "iterative") -> DataFrame:
    """Out-of-sample weekday bias: for each cutoff only errors of targets up to that cutoff.

    Each cutoff adds one marker row per weekday, and a running sum over (key,
    weekday) in date order reads off the errors seen so far: no self join.
    """
    own = detail.where(F.lower("mode") == mode)
    errors = own.select(
        *keys,
        weekday(F.col("target_date")).alias("weekday"),
        F.col("target_date").alias("_at"),
        F.lit(0).alias("_kind"),
        (F.col("predicted") - F.col("actual")).alias("_e"),
    )
    markers = (
        own.select(*keys, F.col("train_end").alias("_at"))
        .distinct()
        .select(
            *keys,
            F.explode(F.sequence(F.lit(0), F.lit(6))).alias("weekday"),
            "_at",
            F.lit(1).alias("_kind"),
            F.lit(None).cast("double").alias("_e"),
        )
    )
    # Errors of one key, weekday and day are combined first, so the window holds at most one row per day.
    daily = errors.groupBy(*keys, "weekday", "_at", "_kind").agg(F.sum("_e").alias("_e"), F.count("_e").alias("_n"))
    marked = markers.withColumn("_n", F.lit(0).cast("long"))
    upto = Window.partitionBy(*keys, "weekday").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    running = daily.unionByName(marked).select(
        *keys, "weekday", "_at", "_kind", F.sum("_e").over(upto).alias("_s"), F.sum("_n").over(upto).alias("_c")
    )
    return running.where(F.col("_kind") == 1).select(
        *keys,
        F.col("_at").alias("train_end"),
        "weekday",
        F.coalesce(-F.try_divide("_s", "_c"), F.lit(0.0)).alias("bias"),
    )


def apply_bias(
    predictions: DataFrame,
    bias: DataFrame | None = None,
    keys: Sequence[str] = (),
    override: float | None = None,
    mode: str | None = "iterative",
) -> DataFrame:
    """Add the bias of the target's weekday (0 where unknown), or one override for all.

    ``bias`` is (keys, weekday, bias). The join is left to the planner: its size
    grows with the keys.
    """
    if override is not None:
        added = F.lit(float(override))
    else:
        found = bias.select(*keys, F.col("weekday").alias("_weekday"), F.col("bias").alias("_bias"))
        predictions = predictions.withColumn("_weekday", weekday(F.col("target_date"))).join(
            found, [*keys, "_weekday"], "left"
        )
        added = F.coalesce(F.col("_bias"), F.lit(0.0))
    if mode is not None and "mode" in predictions.columns:
        added = F.when(F.lower("mode") == mode, added).otherwise(F.lit(0.0))
    return predictions.withColumn("predicted", F.col("predicted") + added).drop("_weekday", "_bias")


def best_switch(detail: DataFrame, keys: Sequence[str] = (), horizon: int | str | DataFrame = 7) -> DataFrame:
    """(keys, switch): s minimising iterative MAE of steps <= s plus multi MAE of steps > s.

    ``horizon`` is a number, a column of ``detail``, or a frame (keys, horizon); a key absent
    from that frame is left out. A step without rows costs infinity and ties go to the
    smallest s. Rows collapse to one per key and step, then to one per key, before a frame
    of horizons is joined.
    """

    def mae(mode: str) -> Column:
        return F.avg(F.when(F.lower("mode") == mode, F.col("abs_error")))

    limit = F.max(horizon) if isinstance(horizon, str) else F.lit(horizon if isinstance(horizon, int) else None).cast("int")
    costs = detail.groupBy(*keys, "step").agg(limit.alias("_h"), mae(PAIR[0]).alias("it"), mae(PAIR[1]).alias("mu"))
    return cheapest_switch(costs, keys, horizon)


def cheapest_switch(costs: DataFrame, keys: Sequence[str], horizon: int | str | DataFrame) -> DataFrame:
    """The switch from (keys, step, _h, it, mu), the mean absolute errors of both modes by step."""
    table = costs.groupBy(*keys).agg(
        F.max("_h").alias("_h"), F.map_from_entries(F.collect_list(F.struct("step", F.struct("it", "mu")))).alias("_costs")
    )
    if isinstance(horizon, DataFrame):
        table = table.drop("_h").join(horizon.select(*keys, F.col("horizon").alias("_h")), [*keys])
    elif isinstance(horizon, int):
        table = table.withColumn("_h", F.lit(horizon))  # also for a table without rows
    steps = F.sequence(F.lit(1), F.col("_h"))

    def cost(step: Column, switch: Column) -> Column:
        own = F.try_element_at("_costs", step)
        return F.coalesce(F.when(step <= switch, own["it"]).otherwise(own["mu"]), F.lit(float("inf")))

    options = F.transform(
        steps, lambda s: F.struct(F.aggregate(steps, F.lit(0.0), lambda total, k: total + cost(k, s)).alias("total"), s.alias("s"))
    )
    return table.select(*keys, F.array_min(options)["s"].alias("switch"))


def error_distribution(detail: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Box-plot numbers per (mode, step): quartiles, and whiskers at the last rows within 1.5 IQR.

    One pass over the detail: everything comes from its counted distinct errors.
    """
    groups = [*keys, "mode", "step"]
    counted = counted_values(detail, groups, "error")
    boxes = quantiles_of_counts(counted, groups, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        counted.join(boxes, groups)
        .groupBy(*groups)
        .agg(
            F.sum("n").alias("count"),
            *[F.first(c).alias(c) for c in ("q1", "median", "q3")],
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        )
    )


def residuals(pivoted: DataFrame, keys: Sequence[str] = (), modes: Sequence[str] = PAIR) -> DataFrame:
    """(keys, mode, target_date, step, train_end, residual) of the given modes."""
    runs = F.array(
        *[
            F.struct(F.lit(m).alias("mode"), (F.col(f"{m}_predicted") - F.col("actual")).alias("residual"))
            for m in modes
        ]
    )
    return (
        pivoted.select(*keys, "train_end", "target_date", "step", F.explode(runs).alias("_r"))
        .select(*keys, "_r.mode", "train_end", "target_date", "step", "_r.residual")
        .where(F.col("residual").isNotNull())
    )
