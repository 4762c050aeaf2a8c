"""Benchmark passages in training texts, found in an FM-index per shard of texts."""

from __future__ import annotations

import pickle
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.sources.message_files import opened

from .common import saved_at
from .fm_index import FMIndex

#: Bytes of benchmark text that are searched at a time; a larger benchmark is a table of blocks.
BLOCK_BYTES = 4 << 20
#: A shard is indexed when it holds so many words.
SHARD_WORDS = 1 << 20
#: Texts that are taken out of a batch, and windows that are looked up, at a time.
TEXTS_HELD = 256
WINDOWS_HELD = 1 << 16

# Lower-cases A-Z and turns ASCII bytes that belong to no word into spaces.
FOLD = bytes(
    b | 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


@dataclass
class Phrases:
    """Distinct windows of a block of benchmark items."""

    vocabulary: list[bytes]
    by_length: dict[int, tuple[np.ndarray, np.ndarray]]  # length -> (windows, number of the group of items)
    groups: list[list[str]]  # items that share a window


def phrases(items: Iterable[tuple[str | None, str | None]], window: int) -> Phrases:
    """Windows of ``window`` words; an item with fewer words, but some, is one window."""
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text or "")]
        for i in range(max(1, len(ids) - window + 1)) if ids else ():
            owners[tuple(ids[i : i + window])].update(() if item is None else (item,))
    groups: dict[frozenset[str], int] = {}
    lengths: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for key, own in owners.items():
        lengths[len(key)].append((key, groups.setdefault(frozenset(own), len(groups))))
    by_length = {n: (np.array([k for k, _ in v], np.int32), np.array([g for _, g in v], np.int64)) for n, v in lengths.items()}
    return Phrases(list(vocabulary), by_length, [sorted(g) for g in groups])


def parts(block: Phrases) -> tuple:
    return block.vocabulary, block.by_length, block.groups


@dataclass
class Blocks:
    """The benchmark's phrases for tasks: one block that is broadcast, or the files of a table of blocks."""

    shared: Broadcast | None
    path: str
    shard_words: int

    def each(self) -> Iterator[Phrases]:
        if self.shared is not None:
            yield Phrases(*self.shared.value)
            return
        system, folder = opened(self.path)
        for info in sorted(system.get_file_info(fs.FileSelector(folder)), key=lambda f: f.path):
            if info.path.endswith(".parquet"):
                with system.open_input_file(info.path) as file:
                    for batch in pq.ParquetFile(file).iter_batches(1, columns=["phrases"]):
                        yield Phrases(*pickle.loads(batch.column(0)[0].as_py()))


class Shard:
    """All words of some texts by the words' own numbers; a word's bytes are held once, whatever its occurrences."""

    def __init__(self, texts: Iterable[list[bytes]] = ()):
        self.numbers: dict[bytes, int] = {}
        self.symbols = array("i")
        self.base = array("q", [0])
        for words in texts:
            self.add(words)

    def add(self, words: list[bytes]) -> None:
        numbers = self.numbers
        self.symbols.fromlist([numbers.setdefault(w, len(numbers) + 1) for w in words])
        self.symbols.append(0)
        self.base.append(len(self.symbols))

    def words(self) -> int:
        return len(self.symbols) - len(self.base) + 1

    def index(self) -> FMIndex:
        return FMIndex(np.frombuffer(self.symbols, np.intc), len(self.numbers) + 1)

    def occurrences(self, index: FMIndex, block: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first word, word after the last, number of the group of items) of every window's occurrences, in runs of windows."""
        own = np.fromiter((self.numbers.get(w, 0) for w in block.vocabulary), np.int32, len(block.vocabulary))
        for length, (windows, group) in block.by_length.items():
            for at in range(0, len(windows), WINDOWS_HELD):
                here = own[windows[at : at + WINDOWS_HELD]]
                known = np.flatnonzero((here > 0).all(1))
                of, position = index.occurrences(here[known])
                yield position, position + length, group[known[of] + at]


def search_shard(blocks: Iterable[Phrases], texts: Shard | Iterable[list[bytes]]) -> tuple[list[list[tuple[int, int]]], list[list[str]]]:
    """Per text the merged word ranges of all occurrences, and the items; one index, whatever the blocks."""
    shard = texts if isinstance(texts, Shard) else Shard(texts)
    base = np.frombuffer(shard.base, np.int64)
    spans: list[list[tuple[int, int]]] = [[] for _ in base[1:]]
    items: list[set[str]] = [set() for _ in base[1:]]
    edge = np.zeros(int(base[-1]) + 1, np.int32)
    index = shard.index()
    for block in blocks:
        for first, last, group in shard.occurrences(index, block):
            np.add.at(edge, first, 1)
            np.subtract.at(edge, last, 1)
            text = np.searchsorted(base, first, "right") - 1
            for key in np.unique(text * len(block.groups) + group).tolist():
                items[key // len(block.groups)].update(block.groups[key % len(block.groups)])
    hit = np.concatenate([[False], np.cumsum(edge, dtype=np.int32)[:-1] > 0, [False]])
    begins, stops = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(~hit[1:] & hit[:-1])
    for text, begin, stop in zip((np.searchsorted(base, begins, "right") - 1).tolist(), begins.tolist(), stops.tolist()):
        spans[text].append((begin - int(base[text]), stop - int(base[text])))
    return spans, [sorted(x) for x in items]


def search(texts: Iterable[str | None], blocks: Blocks) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
    """(words, ranges, items) of every text; texts are gathered to shards of a number of words.

    Of a shard only its words' numbers are held, and nothing when its results are handed on.
    """
    shard = Shard()

    def found() -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
        counts = (np.diff(np.frombuffer(shard.base, np.int64)) - 1).tolist()
        return zip(counts, *search_shard(blocks.each(), shard))

    for text in texts:
        shard.add(words_of(text or ""))
        if shard.words() >= blocks.shard_words:
            results, shard = found(), Shard()
            yield from results
    if len(shard.base) > 1:
        results, shard = found(), Shard()
        yield from results


def texts_in(column: pa.Array) -> Iterator[str | None]:
    """The texts of a batch, a few at a time."""
    for at in range(0, len(column), TEXTS_HELD):
        yield from column.slice(at, TEXTS_HELD).to_pylist()


RANGES = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
PA_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def blocks_of(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> Blocks:
    """The benchmark's windows in blocks of bounded text; equal items count once."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // BLOCK_BYTES) or 1
    if count == 1:
        rows = [(r["item"], r["text"]) for r in items.collect()]
        return Blocks(benchmark.sparkSession.sparkContext.broadcast(parts(phrases(rows, window))), "", SHARD_WORDS)

    def block(rows: pa.Table) -> pa.Table:
        found = phrases(zip(rows["item"].to_pylist(), rows["text"].to_pylist()), window)
        return pa.table({"phrases": pa.array([pickle.dumps(parts(found))], pa.binary())})

    numbered = items.distinct().withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count)))
    return Blocks(None, saved_at(numbered.groupBy("block").applyInArrow(block, "phrases binary"), "benchmark")[1], SHARD_WORDS)


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Occurrences of benchmark windows: (id, n_words, spans, items).

    Words are runs of non-ASCII characters, digits and letters, A-Z lower-cased. spans are
    the merged word ranges of all occurrences, end exclusive, items the sorted ids, as
    text, of the items with an occurring window. A null text has no words, neither has a
    null item; an item without id marks words but isn't listed. Repeated rows each get
    their row, items of one id count together, other columns are left out, empty tables
    give rows without hits or no rows.

    A map over the rows without an exchange: each task gathers texts to a shard of bounded
    size, indexes all its words once, and searches all windows. A benchmark beyond
    ``BLOCK_BYTES`` is a table of blocks, which tasks read one after another.
    """
    first = [T.StructField("id", docs.schema[id_col].dataType)]
    found = [T.StructField("n_words", T.LongType()), T.StructField("spans", RANGES), T.StructField("items", T.ArrayType(T.StringType()))]
    blocks = blocks_of(benchmark, window, item_col, item_text_col)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = list(search(texts_in(batch.column(1)), blocks))
            columns = [
                batch.column(0),
                pa.array([n for n, _, _ in results], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in x] for _, x, _ in results], PA_RANGES),
                pa.array([x for _, _, x in results], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "spans", "items"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(hits, T.StructType(first + found)).select(F.col("id").alias(id_col), "n_words", "spans", "items")


def cut_words(text: str, ranges: list[tuple[int, int]], mark: str = "\n") -> str:
    """The text without the words of the ranges and what stands between them."""
    at = [m.span() for m in WORD.finditer(text)]
    out, last = [], 0
    for start, end in ranges:
        out += [text[last : at[start][0]], mark]
        last = at[end - 1][1]
    return "".join([*out, text[last:]])


def without_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text_col: str = "text",
    chars_col: str = "n_chars",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The same rows and columns, the words of benchmark passages cut out of the texts.

    A cut leaves a line break. Rows are all kept, null texts stay null, the column of text
    lengths follows the new text if there is one, other columns pass through whatever
    their names. The word ranges of all blocks of a benchmark are gathered on the text as
    given, then cut at once.
    """
    names = docs.columns
    text_at, chars_at = names.index(text_col), names.index(chars_col) if chars_col in names else None
    blocks = blocks_of(benchmark, window, item_col, item_text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = search(texts_in(batch.column(text_at)), blocks)
            for at in range(0, batch.num_rows, TEXTS_HELD):
                columns = list(batch.slice(at, TEXTS_HELD).columns)
                texts = columns[text_at].to_pylist()
                new = [cut_words(t, spans) if spans else t for t, (_, spans, _) in zip(texts, found)]
                columns[text_at] = pa.array(new, columns[text_at].type)
                if chars_at is not None:
                    given = columns[chars_at].to_pylist()
                    columns[chars_at] = pa.array([g if t is o else len(t) for g, t, o in zip(given, new, texts)], columns[chars_at].type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(cut, docs.schema)
