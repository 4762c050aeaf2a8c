"""Proportional stratified interleaving of rows into equal shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hex_number, root_buckets, saved

DRAW_DIGITS = 15
PHASE_DIGITS = 8


def interleaved_shards(
    docs: DataFrame,
    shards: int = 8,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "source",
) -> DataFrame:
    """Cut the rows into ``shards`` runs of which each holds the mixture of strata.

    Rows of a stratum are put in the order of a seeded draw on the id. A row with rank
    r of n gets the place (r + phase) / n, where the phase is a seeded number of the
    stratum in [0, 1), so that strata of few rows don't meet in one place. All rows
    sorted by place are cut into runs whose counts are at most one apart.

    Returns (id, size, text_crc32, stratum, shard, slot): size is the text's UTF-8
    bytes plus one, slot the gapless place in the shard. A null text has size 1 and
    crc 0, like an empty one. Null strata are a stratum of their own, null ids draw
    one number. Ties go by draw, id, crc and size; rows equal in all of them are
    interchangeable. Other columns are left out; an empty table gives no rows.

    Ranks never need one task for a stratum or for the whole: rows are counted by
    bucket of the draw (then of the place), counts are summed over the list of
    buckets, and a row number is taken inside a bucket.
    """
    ident = F.col(id_col)
    rows = saved(
        docs.select(
            ident.alias("id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"),
            F.col(stratum_col).cast("string").alias("given"),
            F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit("-")).alias("stratum"),
            hex_number(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(ident.cast("string"), F.lit("-")))), DRAW_DIGITS).alias("draw"),
        ),
        "shard-rows",
    )
    total = rows.count()
    buckets = root_buckets(total)
    bits = 4 * DRAW_DIGITS - (buckets.bit_length() - 1)

    rows = rows.withColumn("bucket", F.shiftright("draw", bits))
    by_stratum = Window.partitionBy("stratum")
    counts = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    counts = counts.select(
        "stratum",
        "bucket",
        (F.sum("n").over(by_stratum.orderBy("bucket")) - F.col("n")).alias("before"),
        F.sum("n").over(by_stratum).alias("of"),
    )
    inside = Window.partitionBy("stratum", "bucket").orderBy("draw", "id", "crc", "size")
    phase = hex_number(F.md5(F.concat_ws(":", F.lit(str(seed)), "stratum")), PHASE_DIGITS) / F.lit(float(16**PHASE_DIGITS))
    rank = F.col("before") + F.row_number().over(inside) - 1
    placed = saved(
        rows.join(counts, ["stratum", "bucket"]).select(
            "id", "size", "crc", "given", "stratum", "draw", ((rank + phase) / F.col("of")).alias("place")
        ),
        "shard-places",
    )

    placed = placed.withColumn("cell", F.floor(F.col("place") * buckets))
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"))
    cells = cells.select("cell", (F.sum("n").over(Window.orderBy("cell")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("cell").orderBy("place", "stratum", "draw", "id", "crc", "size")
    position = (F.col("before") + F.row_number().over(inside) - 1).cast("long")
    shard = F.expr(f"position * {shards} div {max(total, 1)}")
    start = F.expr(f"(shard * {max(total, 1)} + {shards - 1}) div {shards}")
    return (
        placed.join(cells, "cell")
        .withColumn("position", position)
        .withColumn("shard", shard)
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            F.col("given").alias("stratum"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("position") - start).alias("slot"),
        )
    )
