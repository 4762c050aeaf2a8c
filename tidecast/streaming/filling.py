"""Gap fill as days come in: each batch gives the days it adds or changes and the gaps beside them, nothing else."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidecast.operators.series import KEYS, LONGEST_GAP, fill_gaps

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Known days before a series' newest one that stay open for further values.
OPEN_DAYS = 35
DAY = "datetime64[D]"


def merged(known: np.ndarray, totals: np.ndarray, days: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(days, totals, changed): values added to the totals of their days, all sorted by day."""
    every, place = np.unique(np.concatenate([known, days]), return_inverse=True)
    total = np.bincount(place, np.concatenate([totals, values]), len(every))
    return every, total, np.unique(place[len(known) :])


def changed_days(days: np.ndarray, totals: np.ndarray, changed: np.ndarray, longest_gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(day, y, is_filled) of the changed known days and of all days in the gaps beside them."""
    gaps = np.unique(np.concatenate([changed - 1, changed]))
    gaps = gaps[(gaps >= 0) & (gaps < len(days) - 1)]
    width = days[gaps + 1] - days[gaps]
    if (width > longest_gap).any():
        first = np.datetime64(int(days[gaps][width > longest_gap][0]), "D")
        raise ValueError(f"gap of more than {longest_gap} days after {first}")
    inside = width - 1
    of = np.repeat(gaps, inside)
    step = np.arange(len(of)) - np.repeat(np.cumsum(inside) - inside, inside) + 1
    between = totals[of] + (totals[of + 1] - totals[of]) * step / np.repeat(width, inside)
    filled = np.concatenate([np.zeros(len(changed), bool), np.ones(len(of), bool)])
    return np.concatenate([days[changed], days[of] + step]), np.concatenate([totals[changed], between]), filled


def filled_changes(parts: DataFrame, keys: Sequence[str] = KEYS, open_days: int = OPEN_DAYS, longest_gap: int = LONGEST_GAP) -> DataFrame:
    """(keys, date, y, is_filled, is_late) from a stream of (keys, date, y), whose values of a day add up.

    State per series: the known days of the last ``open_days`` days and the one before them, with
    their totals. A day in that reach may be new, also inside a gap, or get a further value; it
    comes out again with the gaps beside it. A value for an older day can't be placed by the
    state and comes out as late, as it came in; ``read_filled`` adds it. Rows without date or
    value are left out. ``parts`` should hold a row a day, like those of ``store_day_parts``, so
    that a hot series is no more than its days.
    """
    rows = parts.select(*keys, F.unix_date("date").alias("_day"), F.col("y").cast("double").alias("_y")).dropna(subset=["_day", "_y"])
    kinds = [parts.schema[k] for k in keys]
    out = T.StructType(
        [
            *kinds,
            T.StructField("date", T.DateType()),
            T.StructField("y", T.DoubleType()),
            T.StructField("is_filled", T.BooleanType()),
            T.StructField("is_late", T.BooleanType()),
        ]
    )

    def update(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(frames))
        days, values = came["_day"].to_numpy(np.int64), came["_y"].to_numpy(float)
        known, totals, closed = np.zeros(0, np.int64), np.zeros(0), False
        if state.exists:
            a, b, closed = state.get
            known, totals = np.frombuffer(a, np.int64), np.frombuffer(b, float)
        late = (days <= known[0]) if closed else np.zeros(len(days), bool)
        known, totals, changed = merged(known, totals, days[~late], values[~late])
        day, y, filled = changed_days(known, totals, changed, longest_gap)
        keep = max(0, int(np.searchsorted(known, known[-1] - open_days)) - 1)
        state.update((known[keep:].tobytes(), totals[keep:].tobytes(), bool(closed or keep)))
        none = np.zeros(late.sum(), bool)
        frame = pd.DataFrame({k: [v] * (len(day) + len(none)) for k, v in zip(keys, key)}, dtype=object)
        frame["date"] = np.concatenate([day, days[late]]).astype(DAY).astype(object)
        frame["y"], frame["is_filled"] = np.concatenate([y, values[late]]), np.concatenate([filled, none])
        frame["is_late"] = np.concatenate([np.zeros(len(day), bool), ~none])
        yield frame

    state = "days binary, totals binary, closed boolean"
    return rows.groupBy(*keys).applyInPandasWithState(update, out, state, "update", GroupStateTimeout.NoTimeout)


def store_filled(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch's days in a folder of its own; a repeated batch overwrites it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def read_filled(spark: SparkSession, path: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, date, y, is_filled): each day as the newest batch left it.

    Only series with late values are filled anew, from their known days and those values. Every
    batch of a lost checkpoint must be removed before the stream starts again.
    """
    log = spark.read.option("basePath", path).parquet(path)
    newest = F.max_by(F.struct("y", "is_filled"), "batch")
    days = log.where("not is_late").groupBy(*keys, "date").agg(newest.alias("_row")).select(*keys, "date", "_row.*")
    late = log.where("is_late").select(*keys, "date", "y")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    behind = late.select(*keys).distinct()
    whole = days.alias("a").join(behind.alias("b"), same, "left_anti")
    known = days.where("not is_filled").alias("a").join(behind.alias("b"), same, "left_semi").select(*keys, "date", "y")
    return whole.unionByName(fill_gaps(known.unionByName(late), keys, "sum"))
