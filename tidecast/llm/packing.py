"""Packing token sequences into windows by non-negative least squares over length counts."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept_in_process, root_buckets, saved

END_ID = 0
SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of a public byte-level vocabulary: ``name.json`` gives the ids, ``name.tiktoken`` the same ones faster."""

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if SPECIAL in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


def encoder(name: str) -> Encoder:
    """One encoder per worker process, however many tasks it runs."""
    kept = kept_in_process()
    if name not in kept:
        kept[name] = Encoder(name)
    return kept[name]


def tokenised(docs: DataFrame, tokenizer: str, window: int, id_col: str, text_col: str) -> DataFrame:
    """(id, tokens, tail, tail_crc, tail_ids, block_crcs): a document cut into full windows and a tail."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("tokens", T.LongType()),
            T.StructField("tail", T.IntegerType()),
            T.StructField("tail_crc", T.LongType()),
            T.StructField("tail_ids", T.BinaryType()),
            T.StructField("block_crcs", T.ArrayType(T.LongType())),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            tokens, tails, crcs, kept, blocks = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = np.append(own.ids(text or ""), np.uint32(END_ID)).astype("<u4")
                full = len(ids) // window
                tail = ids[full * window :]
                tokens.append(len(ids))
                tails.append(len(tail))
                crcs.append(zlib.crc32(tail.tobytes()))
                kept.append(tail.tobytes())
                blocks.append([zlib.crc32(ids[i * window : (i + 1) * window].tobytes()) for i in range(full)])
            columns = [
                batch.column(0),
                pa.array(tokens, pa.int64()),
                pa.array(tails, pa.int32()),
                pa.array(crcs, pa.int64()),
                pa.array(kept, pa.binary()),
                pa.array(blocks, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(encode, schema)


def combinations(counts: np.ndarray, window: int, triples: int) -> np.ndarray:
    """Rows of three lengths (0: none) that sum to the window: all pairs, and the best stocked triples."""
    half = np.arange(1, window // 2 + 1)
    pairs = np.stack([window - half, half, np.zeros_like(half)], 1)
    pairs = pairs[(counts[pairs[:, 0]] > 0) & (counts[pairs[:, 1]] > 0)]
    a, b = np.meshgrid(np.arange(1, window), np.arange(1, window), indexing="ij")
    c = window - a - b
    good = (a >= b) & (b >= c) & (c >= 1)
    found = np.stack([a[good], b[good], c[good]], 1)
    stock = counts[found].min(1)
    found, stock = found[stock > 0], stock[stock > 0]
    best = np.lexsort((found[:, 1], found[:, 0], -stock))[:triples]
    return np.concatenate([pairs, found[best]])


def nnls(columns: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that bring the used lengths near ``counts`` in least squares.

    Accelerated projected gradient; a column has three entries at most, so products are
    sums over its lengths. Entry 0 stands for no length.
    """
    if not len(columns):
        return np.zeros(0)
    size = len(counts)

    def used(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(columns[:, j], weights=x, minlength=size) for j in range(columns.shape[1]))
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return r[columns].sum(1)

    v = np.ones(len(columns))
    for _ in range(20):  # largest eigenvalue
        v = back(used(v))
        step = np.linalg.norm(v)
        v /= step
    goal = counts.astype(float)
    goal[0] = 0
    x = y = np.zeros(len(columns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(used(y) - goal) / (1.05 * step))
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x


@dataclass
class Plan:
    """Where the tails go: by length and rank into combinations, the rest into a stream."""

    window: int
    rules: dict[int, np.ndarray] = field(default_factory=dict)  # length -> rows (first rank, first sequence, offset)
    used: dict[int, int] = field(default_factory=dict)  # length -> ranks in combinations
    stream_at: dict[int, int] = field(default_factory=dict)  # length -> place of its first streamed token
    stream_first: int = 0  # first sequence of the stream
    stream_total: int = 0
    sequences: int = 0

    def cuts(self) -> list[int]:
        """Ends of the sequences in the last, open window of the stream: powers of two."""
        full, rest = divmod(self.stream_total, self.window)
        at, ends = full * self.window, []
        for bit in range(rest.bit_length() - 1, -1, -1):
            if rest >> bit & 1:
                at += 1 << bit
                ends.append(at)
        return ends


def plan_tails(counts: np.ndarray, window: int, triples: int = 4096) -> Plan:
    """Repeat counts by ``nnls``, rounded, topped up, and what is left as one stream.

    Streamed tails stand one after another, longest first, and are cut where a window
    ends, so that only the last window is open; that one is cut at powers of two.
    """
    plan = Plan(window)
    columns = combinations(counts, window, triples)
    wanted = np.rint(nnls(columns, counts)).astype(np.int64)
    left = counts.astype(np.int64).copy()
    times = np.zeros(len(columns), np.int64)
    order = np.argsort(-wanted, kind="stable")
    for limit in (wanted, None):  # as solved, then whatever still fits whole
        for c in order:
            lengths, need = np.unique(columns[c][columns[c] > 0], return_counts=True)
            t = int((left[lengths] // need).min())
            t = t if limit is None else min(t, int(limit[c]))
            if t > 0:
                left[lengths] -= t * need
                times[c] += t
    rules: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    for c in order:
        if times[c]:
            offset = 0
            for length in columns[c][columns[c] > 0].tolist():
                rules.setdefault(length, []).append((taken.get(length, 0), plan.sequences, offset))
                taken[length] = taken.get(length, 0) + int(times[c])
                offset += length
            plan.sequences += int(times[c])
    plan.rules = {k: np.array(v, np.int64) for k, v in rules.items()}
    plan.used = taken
    plan.stream_first = plan.sequences
    for length in range(window - 1, 0, -1):
        if left[length]:
            plan.stream_at[length] = plan.stream_total
            plan.stream_total += int(left[length]) * length
    plan.sequences += plan.stream_total // window + len(plan.cuts())
    return plan


def tail_pieces(plan: Plan, length: int, rank: int, ends: list[int]) -> list[tuple[int, int, int, int]]:
    """(start in the tail, length, sequence, offset) of the tail with this rank among its length."""
    if rank < plan.used.get(length, 0):
        rules = plan.rules[length]
        first, sequence, offset = rules[np.searchsorted(rules[:, 0], rank, "right") - 1].tolist()
        return [(0, length, sequence + rank - first, offset)]
    at = plan.stream_at[length] + (rank - plan.used.get(length, 0)) * length
    stop, start, out = at + length, 0, []
    last_full = plan.stream_total // plan.window
    while at < stop:
        sequence = at // plan.window
        if sequence < last_full:
            end, offset = (sequence + 1) * plan.window, at % plan.window
        else:
            k = next(i for i, e in enumerate(ends) if e > at)
            end, offset, sequence = ends[k], at - (ends[k - 1] if k else last_full * plan.window), last_full + k
        size = min(stop, end) - at
        out.append((start, size, plan.stream_first + sequence, offset))
        at, start = at + size, start + size
    return out


def packed(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k",
    window: int = 1024,
    triples: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack the token ids of all texts, each closed by id 0, into sequences of at most ``window``.

    Full windows of a text are sequences of their own. The tails' lengths are counted (a
    table of ``window`` rows at most, all that reaches the driver) and packed by
    ``plan_tails``; ``triples`` bounds the combinations of three lengths. Every tail gets
    its rank among the tails of its length: counts by (length, bucket) are summed over the
    buckets, and a row number is taken in the bucket, so a length that holds most of the
    tails is spread.

    Returns a row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset). Only sequences of the open end of the stream are shorter than the window, and
    those have powers of two as lengths, so no sequence needs padding. A null text is
    empty and has the one id 0. Repeated rows are packed like any others, null ids are
    kept, other columns are left out, an empty table gives no rows.
    """
    rows = saved(tokenised(docs, tokenizer, window, id_col, text_col), "tokens")
    buckets = max(1, root_buckets(rows.count()) // 8)
    rows = rows.withColumn("draw", F.xxhash64("id", "tail_crc", "tokens")).withColumn("blocks", F.size("block_crcs"))
    rows = rows.withColumn("bucket", F.pmod("draw", F.lit(buckets)))
    stats = saved(rows.groupBy("tail", "bucket").agg(F.count("*").alias("n"), F.sum("blocks").alias("b")), "tail-counts")
    totals = {r["tail"]: (r["n"], r["b"]) for r in stats.groupBy("tail").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).collect()}

    counts = np.zeros(window, np.int64)
    first_block: dict[int, int] = {}
    for tail, (n, _) in totals.items():
        if tail:
            counts[tail] = n
    plan = plan_tails(counts, window, triples)
    blocks = plan.sequences
    for tail in sorted(totals):
        first_block[tail] = blocks
        blocks += totals[tail][1]

    over = Window.partitionBy("tail").orderBy("bucket")
    stats = stats.select(
        "tail", "bucket", (F.sum("n").over(over) - F.col("n")).alias("ranks"), (F.sum("b").over(over) - F.col("b")).alias("at")
    )
    inside = Window.partitionBy("tail", "bucket").orderBy("draw", "id", "tail_crc", "tokens")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.join(stats, ["tail", "bucket"]).select(
        "id",
        "tokens",
        "tail",
        "tail_crc",
        "tail_ids",
        "block_crcs",
        (F.col("ranks") + F.row_number().over(inside) - 1).alias("rank"),
        (F.col("at") + F.sum("blocks").over(so_far) - F.col("blocks")).alias("block_at"),
    )
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)] + [T.StructField(c, T.LongType()) for c in names])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = plan.cuts()
        for batch in batches:
            of: list[int] = []
            out: list[tuple[int, ...]] = []
            columns = [batch.column(i).to_pylist() for i in range(1, batch.num_columns)]
            for i, (tokens, tail, crc, ids, crcs, rank, at) in enumerate(zip(*columns)):
                sequence = first_block[tail] + at
                for k, block in enumerate(crcs):
                    out.append((k * window, window, block, tokens, sequence + k, 0))
                if tail:
                    base = len(crcs) * window
                    for start, size, sequence, offset in tail_pieces(plan, tail, rank, ends):
                        own = crc if size == tail else zlib.crc32(ids[4 * start : 4 * (start + size)])
                        out.append((base + start, size, own, tokens, sequence, offset))
                of += [i] * (len(out) - len(of))
            values = np.array(out, np.int64).reshape(-1, len(names))
            arrays = [batch.column(0).take(pa.array(of, pa.int64()))] + [pa.array(values[:, j]) for j in range(len(names))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return ranked.mapInArrow(place, schema)
