"""How filters interact: for every order of them, what each step removes, by part and label."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved

SPACES = r"[\x20\x09-\x0D]+"
#: A text with at least this share of all rows is joined by broadcast; there can be no more than its inverse of them.
HOT_SHARE = 0.001


def text_failures(text: Column) -> dict[str, Column]:
    """Whether a text fails each of the filters that look at it alone."""
    words = F.array_remove(F.split(text, SPACES), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def copies(rows: DataFrame, id_col: str, key: str) -> DataFrame:
    """``rows`` with ``copy``: whether a row with a smaller id has the same ``key``.

    Keys are counted with a partial step in each task. Those that hold ``HOT_SHARE`` of all rows
    are at most 1 / ``HOT_SHARE`` many, so they are broadcast and their rows stay where they are;
    the rows of other keys are joined, no key of which is large. Rows without id are no copies and
    make none.
    """
    smallest = F.min(id_col).alias("_first")
    repeated = saved(rows.groupBy(key).agg(smallest, F.count("*").alias("_n")).where("_n > 1"), "audit-repeated")
    limit = max(2.0, rows.count() * HOT_SHARE)
    hot = F.broadcast(repeated.where(F.col("_n") >= limit).select(key, "_first"))
    rare = repeated.where(F.col("_n") < limit).select(key, "_first")
    parts = [rows.join(hot, key), rows.join(hot.select(key), key, "left_anti").join(rare, key, "left")]
    later = F.coalesce(F.col(id_col) > F.col("_first"), F.lit(False))
    return reduce(DataFrame.unionByName, [p.withColumn("copy", later).drop("_first") for p in parts])


def survival_words(filters: int) -> np.ndarray:
    """For each set of failed filters the word whose bit s says that the document survives subset s."""
    subsets = np.arange(1 << filters, dtype=np.uint64)
    survives = (subsets[:, None] & subsets[None, :]) == 0
    return (survives.astype(np.uint64) << subsets[None, :]).sum(1).astype(np.uint32)


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set.

    Carry-save addition: three words of one weight become their sum, of that weight, and their
    carry, of twice that weight, for all 32 positions at once, until two are left of each.
    """
    counts = np.zeros(32, np.int64)
    positions = np.arange(32, dtype=np.uint32)
    weight = 1
    while len(words):
        carries = []
        while len(words) > 2:
            n = len(words) // 3
            a, b, c = words[:n], words[n : 2 * n], words[2 * n : 3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * n :]])
        counts += weight * (words[:, None] >> positions & 1).sum(0, dtype=np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def subset_survivors(flagged: DataFrame, filters: Sequence[str], part: str, labels: Sequence[str] = ()) -> DataFrame:
    """(part, subset, documents, one count per label): how many documents survive each subset of at most five filters.

    ``flagged`` has a boolean column per filter (true: fails) and per label. Subset s holds
    filter i where bit i of s is set. Each batch is counted where it is, by part and label; only
    the counts are exchanged. Null flags count as false.
    """
    if len(filters) > 5:
        raise ValueError("a word of 32 bits holds the subsets of five filters")
    kinds = ("documents", *labels)
    failed = reduce(lambda a, b: a + b, [F.coalesce(F.col(f), F.lit(False)).cast("int") * (1 << i) for i, f in enumerate(filters)])
    rows = flagged.select(F.col(part).alias("part"), failed.alias("failed"), *[F.coalesce(F.col(x), F.lit(False)).alias(x) for x in labels])
    schema = T.StructType(
        [T.StructField("part", flagged.schema[part].dataType), T.StructField("subset", T.IntegerType())]
        + [T.StructField(k, T.LongType()) for k in kinds]
    )
    subsets = 1 << len(filters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = survival_words(len(filters))
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(0).dictionary_encode(null_encoding="encode")
            code = parts.indices.to_numpy()
            words = table[batch.column(1).to_numpy()]
            flags = [np.ones(len(words), bool)] + [batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(len(labels))]
            order = np.argsort(code, kind="stable")
            ends = np.cumsum(np.bincount(code, minlength=len(parts.dictionary)))
            runs = np.split(order, ends[:-1])
            counts = [np.concatenate([positional_counts(words[r][f[r]])[:subsets] for r in runs]) for f in flags]
            of = pa.array(np.repeat(np.arange(len(runs)), subsets))
            places = pa.array(np.tile(np.arange(subsets, dtype=np.int32), len(runs)))
            yield pa.RecordBatch.from_arrays([parts.dictionary.take(of), places, *map(pa.array, counts)], names=schema.names)

    counted = rows.mapInArrow(count, schema)
    return counted.groupBy("part", "subset").agg(*[F.sum(k).alias(k) for k in kinds])


def order_report(survivors: DataFrame, filters: Sequence[str], good: str, toxic: str) -> DataFrame:
    """A row per part, order of the filters and step, from the counts of ``subset_survivors``.

    With P the filters before a step and X its own: kept = n[P + X], removed = n[P] - n[P + X],
    redundant = fails of X - removed, unique_fails = n[all but X] - n[all]; shapley adds up what X
    removes over all orders, k! (f - 1 - k)! of which have the same P of k filters.
    """
    kinds = ("documents", good, toxic)
    schema = T.StructType(
        [
            T.StructField("part", survivors.schema["part"].dataType),
            T.StructField("filter_order", T.StringType()),
            T.StructField("step", T.IntegerType()),
        ]
        + [T.StructField(c, T.LongType()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
    )
    full = (1 << len(filters)) - 1
    arrays = [F.array_sort(F.collect_list(F.struct("subset", k))).getField(k).alias(k) for k in kinds]

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = list(itertools.permutations(range(len(filters))))
        for batch in batches:
            for row in batch.to_pylist():
                n, of_good, of_toxic = (row[k] for k in kinds)
                lone = [n[full ^ 1 << x] - n[full] for x in range(len(filters))]
                shapley = [
                    sum(
                        math.factorial(p.bit_count()) * math.factorial(len(filters) - 1 - p.bit_count()) * (n[p] - n[p | 1 << x])
                        for p in range(full + 1)
                        if not p >> x & 1
                    )
                    for x in range(len(filters))
                ]
                out = []
                for order in orders:
                    before = 0
                    for step, x in enumerate(order, 1):
                        after = before | 1 << x
                        removed = n[before] - n[after]
                        losses = (of_good[before] - of_good[after], of_toxic[before] - of_toxic[after])
                        redundant = n[0] - n[1 << x] - removed
                        name = "".join(filters[i] for i in order)
                        out.append((row["part"], name, step, n[after], removed, redundant, lone[x], *losses, shapley[x]))
                        before = after
                columns = [pa.array(c, batch.schema.field("part").type if i == 0 else None) for i, c in enumerate(zip(*out))]
                columns[2] = columns[2].cast(pa.int32())
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return survivors.groupBy("part").agg(*arrays).mapInArrow(report, schema)


def audited(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """What five filters remove in each of their 120 orders, per part of the documents.

    A document fails A with under 200 words, B if fewer than half its words are distinct, C if
    more than 3 % of its code points are A-Z, D if it holds one of ``#$%&*|``, E if a document
    with a smaller id has the same text. Words are runs of other than ASCII white space.

    ``labels`` has ``quality`` and ``toxic``; a document is good (toxic) if any of its rows says
    1. Null texts are empty, null parts the empty string. Ties: rows that repeat an id and a text
    are no copies of each other. Rows without id have no label and are no copies. Other columns
    are left out; empty tables give no rows.

    Returns (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley), zeros included. Only a digest of each text is exchanged.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    failures = text_failures(F.col("text"))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    rows = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(f"fails_{k}") for k, c in failures.items()])
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    marks = marks.agg(F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic"))
    flagged = copies(saved(rows, "audit-flags"), "id", "digest").withColumnRenamed("copy", "fails_E").drop("digest")
    known = flagged.where(F.col("id").isNotNull()).join(marks, "id", "left")
    flagged = known.unionByName(flagged.where(F.col("id").isNull()), allowMissingColumns=True)
    survivors = subset_survivors(flagged, [f"fails_{k}" for k in "ABCDE"], "part", ("good", "toxic"))
    return order_report(survivors, "ABCDE", "good", "toxic")
