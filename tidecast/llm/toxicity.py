"""Toxicity of texts by a linear classifier that a swap of identity terms must not move."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, discard, few_rows, letters, saved_at

#: Bounds of the fit: labelled rows, and features kept of the hashed ones.
FIT_ROWS = 20_000
FEATURES = 4096
#: Least chi-square of a feature: what a few rare words of a small sample reach by chance isn't kept.
LEAST_CHI = 12.0
HASH_BITS = 20
SIZES = (4, 5, 6)
LEVELS = (1, 2, 4)
#: Code points whose n-grams are held at a time, of whole texts.
CHARS_HELD = 1 << 18
LIMIT = 0.7

#: Identity terms by group; a swap takes the next term of the group.
GROUPS: tuple[tuple[str, ...], ...] = (
    ("man", "woman"), ("men", "women"), ("boy", "girl"), ("male", "female"), ("husband", "wife"), ("father", "mother"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"), ("black", "white", "asian", "latino", "arab"),
    ("american", "mexican", "chinese", "indian", "african", "european"), ("blind", "deaf", "disabled"), ("young", "old", "elderly"),
    ("immigrant", "refugee", "foreigner"), ("mann", "frau"), ("homme", "femme"), ("hombre", "mujer"),
)

MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)


def features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed letter n-grams, text numbers), repeats included.

    N-grams lie in a lower-cased word with a space on either side.
    """
    lowered = [t.lower() for t in texts]
    points = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le"), np.uint32)
    is_letter = letters()[points]
    codes = np.where(is_letter, points, 0).astype(np.uint64)
    hashes, at = [], []
    for size in SIZES:
        count = len(codes) - size + 1
        if count <= 0:
            continue
        inner = is_letter[1 : count + 1].copy()
        for j in range(2, size - 1):
            inner &= is_letter[j : count + j]
        start = np.flatnonzero(inner)
        mixed = np.full(len(start), size, np.uint64)
        for j in range(size):
            mixed = (mixed ^ codes[start + j]) * MIX[j]
            mixed ^= mixed >> np.uint64(31)
        hashes.append((mixed >> np.uint64(64 - HASH_BITS)).astype(np.int64))
        at.append(start + 1)
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    return np.concatenate(hashes), np.searchsorted(ends, np.concatenate(at), "left")


def levels_of(found: np.ndarray) -> list[np.ndarray]:
    """The hashed features "at least 1, 2, 4, ... times" of hashed n-grams."""
    top = (1 << HASH_BITS) - 1
    return [found if n == 1 else (found * 2654435761 * (2 * n + 1) >> 7) & top for n in LEVELS]


class Chosen:
    """The features of a model: each one's place, and the n-grams that lead to any."""

    def __init__(self, features: np.ndarray):
        self.features = features
        self.places = np.full(1 << HASH_BITS, -1, np.int32)
        self.places[features] = np.arange(len(features))
        self.wanted = np.any([self.places[x] >= 0 for x in levels_of(np.arange(1 << HASH_BITS))], 0)


def present(texts: Sequence[str], chosen: Chosen | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text numbers, features), each pair once: an n-gram counts by how often it stands in the text.

    With ``chosen`` only its features, as their places.
    """
    parts: list[np.ndarray] = []
    for first, some in chunks(texts, CHARS_HELD):
        found, of = features(some)
        if chosen is not None:
            of, found = of[chosen.wanted[found]], found[chosen.wanted[found]]
        pairs, times = np.unique((of.astype(np.int64) + first) << HASH_BITS | found, return_counts=True)
        for least, level in zip(LEVELS, levels_of(pairs & ((1 << HASH_BITS) - 1))):
            own, text = level[times >= least], pairs[times >= least] >> HASH_BITS
            if chosen is not None:
                own = chosen.places[own]
                text, own = text[own >= 0], own[own >= 0]
            parts.append(text << HASH_BITS | own)
    pairs = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
    pairs = pairs[np.append(np.ones(min(1, len(pairs)), bool), pairs[1:] != pairs[:-1])]
    return pairs >> HASH_BITS, pairs & ((1 << HASH_BITS) - 1)


class Swaps:
    """Counterfactual texts: identity terms swapped in their group, and taken out."""

    def __init__(self, groups: Sequence[Sequence[str]] = GROUPS):
        self.following = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
        terms = sorted(map(re.escape, self.following), key=len, reverse=True)
        self.term = re.compile(r"\b(?:" + "|".join(terms) + r")\b") if terms else None

    def of(self, text: str) -> list[str]:
        """No text without a term. Features are in lower case, and so are these texts."""
        text = text.lower()
        if self.term is None or not self.term.search(text):
            return []
        return [self.term.sub(lambda m: self.following[m[0]], text), self.term.sub("", text)]


@dataclass
class Model:
    chosen: Chosen
    weights: np.ndarray
    bias: float

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        of, found = present(texts, self.chosen)
        logit = np.bincount(of, weights=self.weights[found], minlength=len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def fit_weights(
    rows: Sequence[tuple[int, Sequence[int]]],
    deltas: Sequence[tuple[Sequence[int], Sequence[int]]],
    size: int,
    ridge: float = 2e-5,
    swap: float = 1.0,
    rounds: int = 600,
) -> tuple[np.ndarray, float]:
    """Logistic weights with a ridge, and with a penalty on squared score changes over ``deltas``.

    rows: (label, features); deltas: (features lost, features won) by a swap. Adam on the
    whole sample.
    """
    label = np.array([y for y, _ in rows], float)
    column = np.array([f for _, x in rows for f in x], np.int64)
    row = np.repeat(np.arange(len(rows)), [len(x) for _, x in rows])
    lost = np.array([f for a, b in deltas for f in (*a, *b)], np.int64)
    sign = np.array([s for a, b in deltas for s in (*[-1.0] * len(a), *[1.0] * len(b))])
    of = np.repeat(np.arange(len(deltas)), [len(a) + len(b) for a, b in deltas])
    rate = np.clip(label.mean(), 1e-4, 1 - 1e-4)
    x = np.zeros(size + 1)
    x[size] = np.log(rate / (1 - rate))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for k in range(1, rounds + 1):
        z = np.bincount(row, weights=x[column], minlength=len(rows)) + x[size]
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) / len(rows)
        gradient = np.append(np.bincount(column, weights=error[row], minlength=size) + ridge * x[:size], error.sum())
        if len(deltas):
            change = np.bincount(of, weights=sign * x[lost], minlength=len(deltas))
            gradient[:size] += 2 * swap / len(deltas) * np.bincount(lost, weights=sign * change[of], minlength=size)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        x -= 0.05 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.999**k)) + 1e-9)
    return x[:size], float(x[size])


def learned_model(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    fit_rows: int = FIT_ROWS,
    groups: Sequence[Sequence[str]] = GROUPS,
) -> Model | None:
    """The classifier of at most ``fit_rows`` labelled rows, those with the smallest hashes of their ids.

    Rows without id or label don't count; an id with several labels is toxic if one of
    them is. Features are chosen by their chi-square against the label, over the sample,
    counted in the tasks. The driver gets the chosen features of each sampled row and no
    text. None without labelled texts.
    """
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    marks = marks.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("label"))
    marks = marks.orderBy(F.md5(F.col("id").cast("string")), "id").limit(fit_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the sample's ids are bounded by fit_rows; the sampled rows are one task's output each
    sample, path = saved_at(texts.join(F.broadcast(marks), "id").select("label", "text"), "toxic-sample")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    positive, negative = sizes.get(1, 0), sizes.get(0, 0)
    if not positive + negative:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 1 << HASH_BITS), np.int64)
        for batch in few_rows(batches):
            of, found = present(batch.column(1).to_pylist())
            label = np.array(batch.column(0).to_pylist(), np.int64)[of]
            for y in (0, 1):
                held[y] += np.bincount(found[label == y], minlength=1 << HASH_BITS)
        some = np.flatnonzero(held.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[1][some]), pa.array(held[0][some])], names=["feature", "p", "n"])

    counts = sample.mapInArrow(count, "feature long, p long, n long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    total = positive + negative
    lean = F.col("p") * float(negative) - F.col("n") * float(positive)
    spread = (F.col("p") + F.col("n")) * (total - F.col("p") - F.col("n"))
    chi = lean * lean / spread * (total / (float(positive) * negative or 1.0))
    best = counts.where((spread > 0) & (chi >= LEAST_CHI)).orderBy(chi.desc(), "feature").limit(FEATURES)
    chosen = np.array(sorted(r["feature"] for r in best.select("feature").collect()), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(chosen)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, swaps = Chosen(shared.value), Swaps(groups)

        def sets(some: list[str]) -> list[set[int]]:
            out: list[set[int]] = [set() for _ in some]
            for i, f in zip(*(x.tolist() for x in present(some, own))):
                out[i].add(f)
            return out

        for batch in few_rows(batches):
            given = batch.column(1).to_pylist()
            base = sets(given)
            variants = [(i, v) for i, text in enumerate(given) for v in swaps.of(text)]
            lost: list[list[list[int]]] = [[] for _ in given]
            won: list[list[list[int]]] = [[] for _ in given]
            for (i, _), other in zip(variants, sets([v for _, v in variants])):
                if other != base[i]:
                    lost[i].append(sorted(base[i] - other))
                    won[i].append(sorted(other - base[i]))
            kind = pa.list_(pa.list_(pa.int32()))
            arrays = [batch.column(0), pa.array([sorted(x) for x in base], pa.list_(pa.int32())), pa.array(lost, kind), pa.array(won, kind)]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "features", "lost", "won"])

    fit = sample.mapInArrow(reduce, "label int, features array<int>, lost array<array<int>>, won array<array<int>>").collect()
    discard(docs.sparkSession, path)
    deltas = [pair for r in fit for pair in zip(r["lost"], r["won"])]
    weights, bias = fit_weights([(r["label"], r["features"]) for r in fit], deltas, len(chosen))
    return Model(Chosen(chosen), weights, bias)


def _shared(docs: DataFrame, model: Model | None):
    parts = None if model is None else (model.chosen.features, model.weights, model.bias)
    return docs.sparkSession.sparkContext.broadcast(parts)


def _model(parts: tuple | None) -> Model | None:
    return None if parts is None else Model(Chosen(parts[0]), *parts[1:])


def toxicity(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """Scores of all texts: (id, score, predicted), 1 at ``limit`` and above.

    A null or empty text scores as one without features; without a model all scores are 0.
    Repeated rows each get their row, other columns are left out, an empty table gives no
    rows. A map over the rows, whole texts, no exchange.
    """
    shared = _shared(docs, model)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(shared.value)
        for batch in few_rows(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            values = np.zeros(len(texts)) if own is None else own.scores(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), pa.array((values >= limit).astype(np.int32))], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(score, schema)


def without_toxic(docs: DataFrame, model: Model | None, text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """The rows whose texts score below ``limit``, all columns as they are."""
    shared = _shared(docs, model)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(shared.value)
        for batch in few_rows(batches):
            if own is None:
                yield batch
            else:
                yield batch.filter(pa.array(own.scores([t or "" for t in batch.column(at).to_pylist()]) < limit))

    return docs.mapInArrow(keep, docs.schema)
