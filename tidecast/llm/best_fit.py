"""Packing whole documents into few windows: large ones matched in pairs, smaller ones into the tightest gaps."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.ranking import global_position

from .common import saved
from .packing import END_ID, encoder


def cut(ids: np.ndarray, window: int) -> list[tuple[int, np.ndarray]]:
    """(start, ids) of the pieces: whole windows from the end on, what is left over comes first."""
    first = len(ids) % window or window
    starts = [0, *range(first, len(ids), window)]
    return [(a, ids[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)])]


def pieces_of(docs: DataFrame, tokenizer: str, window: int, id_col: str, text_col: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32): no more than a number for each piece leaves the task that reads the text."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            of, out = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(own.ids(text or ""), np.uint32(END_ID)).astype("<u4")
                for k, (start, part) in enumerate(cut(ids, window)):
                    of.append(i)
                    out.append((k, start, len(part), zlib.crc32(part.tobytes())))
            values = np.array(out, np.int64).reshape(-1, 4)
            columns = [batch.column(0).take(pa.array(of, pa.int64())), pa.array(values[:, 0].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(values[:, j]) for j in range(1, 4)], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(encode, schema)


@dataclass
class Plan:
    """Where pieces go that are numbered by ascending length.

    A rule covers the pieces from its first number up to the next rule's: ``per`` of them, one
    after another from ``offset`` on, in each sequence from ``sequence`` on.
    """

    window: int
    next_item: np.ndarray
    rules: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    gaps: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # gap -> runs of sequences (first, count)
    sizes: list[int] = field(default_factory=list)  # the gaps there are, ascending
    sequences: int = 0

    def opened(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def put(self, length: int, sequence: int, count: int, per: int, offset: int) -> None:
        self.rules.append((int(self.next_item[length]), sequence, per, offset, length))
        self.next_item[length] += count * per

    def leave(self, gap: int, sequence: int, count: int) -> None:
        """These sequences have ``gap`` tokens left."""
        if gap and count:
            if gap not in self.gaps:
                bisect.insort(self.sizes, gap)
            self.gaps.setdefault(gap, []).append((sequence, count))

    def tightest(self, length: int) -> int:
        """The smallest gap that takes ``length``; 0: none."""
        at = bisect.bisect_left(self.sizes, length)
        return self.sizes[at] if at < len(self.sizes) else 0

    def taken(self, gap: int) -> list[tuple[int, int]]:
        self.sizes.remove(gap)
        return self.gaps.pop(gap)

    def table(self) -> np.ndarray:
        return np.array(sorted(self.rules), np.int64).reshape(-1, 5)


def plan_bins(counts: np.ndarray, window: int) -> Plan:
    """The plan for ``counts[length]`` pieces of each length from 1 to ``window``.

    No sequence holds three pieces above a third of the window, so these are matched first:
    from the longest on, each with the longest partner that still fits, which leaves the fewest
    sequences. Pieces of a third at most follow by falling length, each into the sequence with
    the smallest gap that takes it, else into a new one. Sequences with equal gaps are handled
    as runs, so the work depends on the window and not on the number of pieces.
    """
    left = counts.astype(np.int64).copy()
    plan = Plan(window, np.concatenate([[0], np.cumsum(left)[:-1]]))
    third = window // 3
    for length in range(window, third, -1):
        while left[length]:
            longest = min(length, window - length)
            partner = next((p for p in range(longest, third, -1) if left[p] > (p == length)), 0)
            if partner == length:
                bins = int(left[length]) // 2
                first = plan.opened(bins)
                plan.put(length, first, bins, 2, 0)
                left[length] -= 2 * bins
            else:
                bins = int(min(left[length], left[partner]) if partner else left[length])
                first = plan.opened(bins)
                plan.put(length, first, bins, 1, 0)
                left[length] -= bins
                if partner:
                    plan.put(partner, first, bins, 1, length)
                    left[partner] -= bins
            plan.leave(window - length - partner, first, bins)
    for length in range(third, 0, -1):
        n = int(left[length])
        while n:
            gap = plan.tightest(length)
            if gap:
                runs = plan.taken(gap)
            else:
                gap = window
                bins = -(-n // (window // length))
                runs = [(plan.opened(bins), bins)]
            per, used = gap // length, window - gap
            for first, count in runs:
                full = min(count, n // per)
                if full:
                    plan.put(length, first, full, per, used)
                    plan.leave(gap - per * length, first, full)
                    n -= full * per
                if full < count and n:  # fewer than fill one sequence
                    plan.put(length, first + full, 1, n, used)
                    plan.leave(gap - n * length, first + full, 1)
                    full, n = full + 1, 0
                plan.leave(gap, first + full, count - full)
    return plan


def best_fit_packed(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k",
    window: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack the token ids of all texts, each closed by id 0, into few sequences of at most ``window``.

    A text of more than ``window`` ids is cut into whole windows, what is left over comes
    first; no other text is cut. The pieces' lengths are counted (``window`` rows at most, all
    that reaches the driver) and ``plan_bins`` says where pieces of each length go. The pieces
    are then sorted by length, numbered over the whole table, and placed by their number: a
    length that most pieces have is spread over the tasks of the sort like any other.

    Returns a row per piece: (id, piece, start, length, ids_crc32, sequence_id, offset).
    Sequences are numbered from 0, offsets are gapless. A null text is empty and has the one id
    0. Repeated rows are packed like any others, null ids are kept, other columns are left out,
    an empty table gives no rows.
    """
    pieces = pieces_of(docs, tokenizer, window, id_col, text_col)
    pieces = saved(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = np.zeros(window + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    rules = plan_bins(counts, window).table()

    names = ("length", "ids_crc32", "sequence_id", "offset")
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
        ]
        + [T.StructField(c, T.LongType()) for c in names]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, sequences, per, offsets, lengths = rules.T
        for batch in batches:
            number = batch.column(5).to_numpy()
            rule = np.searchsorted(firsts, number, "right") - 1
            nth = number - firsts[rule]
            sequence = sequences[rule] + nth // per[rule]
            offset = offsets[rule] + nth % per[rule] * lengths[rule]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=schema.names)

    numbered = global_position(pieces, ["length", "id", "piece", "row"], "number")
    return numbered.select("id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(place, schema)
