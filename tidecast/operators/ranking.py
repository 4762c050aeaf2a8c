"""Global positions and exact quantiles without putting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidecast.session import shared_folder

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def global_position(df: DataFrame, order: Sequence[str | Column], out: str = "position") -> DataFrame:
    """Number all rows 0, 1, 2, ... in the given order.

    One range exchange sorts the rows; the sorted rows are checkpointed, so both
    readers below see the same partitions even after an executor is lost. Only
    one row per partition, its size, meets in a single task, and that table is
    what is broadcast back: its length is the partition count, not the data.
    """
    shared_folder(df.sparkSession)
    placed = df.orderBy(*order).checkpoint().withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", _ROW_BITS)
    row = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = placed.withColumn("_part", part).withColumn("_row", row).drop("_id")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg((F.max("_row") + 1).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.col("_row"))
        .drop("_part", "_row", "_offset")
    )


def counted_values(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(groups, value, n, before): distinct non-null values, how often each, and how many rows sort before it over all groups.

    Rows collapse to their distinct values first, so a value that most rows hold is one row.
    Those are sorted by a range exchange, which can split any group, and written; counts are
    then summed inside the sorted partitions and over the list of partitions.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    shared_folder(df.sparkSession)
    placed = counts.orderBy(*groups, "value").checkpoint()
    placed = placed.withColumn("_part", F.shiftright(F.monotonically_increasing_id(), _ROW_BITS))
    inside = Window.partitionBy("_part").orderBy(*groups, "value").rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.sum("n").alias("_size")).select("_part", F.coalesce(F.sum("_size").over(parts), F.lit(0)).alias("_offset"))
    running = placed.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return running.join(F.broadcast(offsets), "_part").select(*groups, "value", "n", (F.col("_inside") + F.col("_offset")).alias("before"))


def quantiles_of_counts(counted: DataFrame, groups: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation from ``counted_values``, one row per group."""
    bounds = counted.groupBy(*groups).agg(F.min("before").alias("_start"), F.sum("n").alias("_n"))
    rows = counted.join(bounds, [*groups])
    first, last = F.col("before") - F.col("_start"), F.col("before") - F.col("_start") + F.col("n")

    def at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position < last), F.col("value")))

    picks = []
    for name, q in quantiles.items():
        place = (F.col("_n") - 1) * F.lit(float(q))
        picks += [at(F.floor(place)).alias(f"_{name}_low"), at(F.ceil(place)).alias(f"_{name}_high")]
    out = rows.groupBy(*groups, "_n").agg(*picks)
    return out.select(
        *groups,
        *[
            (F.col(f"_{name}_low") + (F.col(f"_{name}_high") - F.col(f"_{name}_low")) * ((F.col("_n") - 1) * F.lit(float(q)) % 1)).alias(name)
            for name, q in quantiles.items()
        ],
    )


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group, nulls ignored."""
    return quantiles_of_counts(counted_values(df, groups, value), groups, quantiles)
