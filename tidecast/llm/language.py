"""Language of a text by bit-sliced Bloom filters over letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, letters, saved

UNKNOWN = "und"
#: A trigram is in a language's filter if it makes up this share of the language's trigrams;
#: no filter can hold more than 1 / LEAST_SHARE trigrams, whatever the size of the corpus.
LEAST_SHARE = 2e-5
HASHES = 4
BITS_PER_GRAM = 12
#: A task hands on its counts whenever it holds so many different trigrams.
MOST_HELD = 2_000_000
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, text numbers): for each letter of each lower-cased text, it and its neighbours.

    A neighbour that isn't a letter counts as a space, so trigrams don't reach over words.
    """
    lowered = [t.lower() for t in texts]
    points = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le"), np.uint32)
    is_letter = letters()[points]
    codes = np.where(is_letter, points, 0).astype(np.uint64)
    middle = np.flatnonzero(is_letter)
    grams = codes[middle - 1] | codes[middle] << np.uint64(21) | codes[middle + 1] << np.uint64(42)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    return grams, np.searchsorted(ends, middle, "left") if len(texts) else middle


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) over all rows with a language, counted in the tasks before the exchange."""
    schema = "lang string, gram long, n long"

    def emit(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, (grams, n) in held.items():
            arrays = [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "gram", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            langs = batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                for _, some in chunks([t for t, g in zip(texts, langs) if g == lang]):
                    grams, n = np.unique(trigrams(some)[0], return_counts=True)
                    if lang in held:
                        both = np.concatenate([held[lang][0], grams])
                        weight = np.concatenate([held[lang][1], n])
                        grams, at = np.unique(both, return_inverse=True)
                        n = np.bincount(at, weights=weight, minlength=len(grams)).astype(np.int64)
                    held[lang] = (grams, n)
            if sum(len(g) for g, _ in held.values()) > MOST_HELD:
                yield from emit(held)
                held = {}
        yield from emit(held)

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.select(F.col(text_col), F.col(lang_col).cast("string")).mapInArrow(count, schema)
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Filters:
    """One table of language bit masks; a gram's languages are the bits common to its places."""

    langs: list[str]
    masks: np.ndarray  # (places, words of 64 languages)

    def places(self, grams: np.ndarray) -> list[np.ndarray]:
        shift = np.uint64(64 - (len(self.masks).bit_length() - 1))
        return [((grams ^ (grams >> np.uint64(29))) * odd) >> shift for odd in ODD[:HASHES]]

    def add(self, language: int, grams: np.ndarray) -> None:
        for places in self.places(grams):
            self.masks[places, language // 64] |= np.uint64(1 << language % 64)

    def false_rates(self) -> np.ndarray:
        fill = [np.count_nonzero(self.masks[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)) / len(self.masks) for k in range(len(self.langs))]
        return np.array(fill) ** HASHES

    def hits(self, grams: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
        """Per text and language, how many of its grams the language's filter holds."""
        out = np.zeros((texts, len(self.langs)))
        places = self.places(grams)
        for word in range(self.masks.shape[1]):
            slices = self.masks[:, word]
            common = slices[places[0]]
            for p in places[1:]:
                common &= slices[p]
            for k in range(word * 64, min(len(self.langs), word * 64 + 64)):
                bit = (common >> np.uint64(k % 64)) & np.uint64(1)
                out[:, k] = np.bincount(of[bit > 0], minlength=texts)
        return out


def learned_filters(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Filters from all given rows that have a language.

    Counts cover every row; what comes to the driver is bounded by 1 / LEAST_SHARE
    trigrams a language.
    """
    counts = saved(gram_counts(docs, text_col, lang_col), "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    chosen: list[np.ndarray] = []
    for lang in langs:
        rows = counts.where((F.col("lang") == lang) & (F.col("n") >= max(1.0, LEAST_SHARE * totals[lang])))
        chosen.append(rows.select("gram").toPandas()["gram"].to_numpy(np.int64).view(np.uint64))
    most = max([1, *map(len, chosen)])
    places = 1 << (BITS_PER_GRAM * most - 1).bit_length()
    filters = Filters(langs, np.zeros((places, max(1, -(-len(langs) // 64))), np.uint64))
    for k, grams in enumerate(chosen):
        filters.add(k, grams)
    return filters


def identified(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of every text: (id, lang_pred, score).

    A text's trigrams are looked up in all filters at once; counts per language are
    corrected for the filter's false positives, c' = (c - n f) / (1 - f), the largest
    decides (ties: the first name), and the score is its share of all corrected counts. A
    null text or one without letters is ``und`` with score 0, as is every text when no
    language was learned. Repeated rows each get their row, other columns are left out,
    an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((filters.langs, filters.masks))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(*shared.value)
        rates = own.false_rates()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n, hits = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(own.langs)))
            for first, some in chunks(texts):
                grams, of = trigrams(some)
                n[first : first + len(some)] = np.bincount(of, minlength=len(some))
                hits[first : first + len(some)] = own.hits(grams, of, len(some))
            if own.langs:
                corrected = np.maximum(0, (hits - n[:, None] * rates) / (1 - np.minimum(rates, 0.999)))
                best = corrected.argmax(1)
                score = corrected.max(1) / np.maximum(corrected.sum(1), 1e-9)
                langs = [own.langs[k] if some else UNKNOWN for k, some in zip(best, n > 0)]
            else:
                langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            score = np.where(n > 0, score, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(predict, schema)
