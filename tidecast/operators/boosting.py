"""Gradient-boosted regression trees over binned features, grown by any number of tasks that share the rows of a model.

A fit is a generator. It yields sums over its own rows and is sent the sums over all rows, so
the same code grows a tree in one task or in step with others; rows never leave their task.
Labels are counted in whole units, so sums are exact: the trees are the same however
the rows are dealt out.
"""

from __future__ import annotations

import base64
import pickle
import zlib
from collections.abc import Callable, Generator, Iterable, Mapping
from typing import Any

import numpy as np

BINS = 64
#: Equal cells of a feature's range in which its values are counted to find the edges of the bins.
CELLS = 4096
#: Bits of a sum that a double holds exactly, and of a label at most.
SUM_BITS, LABEL_BITS = 52, 30

Request = tuple[str, np.ndarray]  # "sum" or "max" over all tasks of the model
Fit = Generator[Request, np.ndarray, Any]


class Trees:
    """Least-squares boosting: each round fits one tree of fixed depth to the residuals.

    Features are cut at their quantiles into ``BINS`` bins once. A level of a tree takes one
    histogram over (node, feature, bin), of the smaller child of every node only: the larger
    one's is its parent's less that. ``depth`` levels give 2**depth leaves; a node that can't be
    split passes its rows on to the left.
    """

    def __init__(self, rounds: int, step_size: float, depth: int, min_rows: int, feature_share: float, seed: int):
        self.rounds, self.step_size, self.depth = rounds, step_size, depth
        self.min_rows, self.feature_share, self.seed = max(1, min_rows), feature_share, seed

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        return alone(self.growing(x, y))

    def growing(self, x: np.ndarray, y: np.ndarray) -> Fit:
        """Fit to the rows of all tasks that answer the requests; x and y are this task's. None: no task has rows."""
        rng = np.random.default_rng(self.seed)
        width = x.shape[1]
        nothing = np.full((1, width), -np.inf)
        bounds = yield "max", np.concatenate([np.vstack([nothing, -x]).max(0), np.vstack([nothing, x]).max(0), [np.abs(y).max(initial=0.0)]])
        low, high, size = -bounds[:width], bounds[width:-1], bounds[-1]
        if np.isneginf(bounds[: 2 * width]).all():
            return None
        if not np.isfinite(bounds).all():
            raise ValueError("a training row has a null or infinite value")
        fine = yield "sum", np.stack([np.bincount(_cells(x[:, j], low[j], high[j]), minlength=CELLS) for j in range(width)]).astype(float)
        self.rows = int(fine[0].sum())
        self.edges = [_edges(fine[j], low[j], high[j]) for j in range(width)]
        table = Histograms(self._binned(x), [len(e) + 1 for e in self.edges])
        del x, fine

        unit = max(size, np.finfo(float).tiny) / 2.0 ** min(LABEL_BITS, SUM_BITS - self.rows.bit_length())
        left = np.rint(y / unit)
        total = yield "sum", np.array([left.sum()])
        base = np.rint(total[0] / self.rows)
        left -= base
        spread = yield "sum", np.array([np.square(left * unit).sum()])
        self.constant_error = float(spread[0]) / self.rows
        self.base = float(base * unit)
        root = yield "sum", table.counts(np.arange(width), np.zeros(len(left), np.int64), 1)
        self.splits: list[list[tuple[np.ndarray, np.ndarray]]] = []
        self.leaves: list[np.ndarray] = []
        shared = max(1, round(self.feature_share * width))
        for _ in range(self.rounds):
            chosen = np.sort(rng.permutation(width)[:shared])
            starts, features, bins = table.layout(chosen)
            node, levels = np.zeros(len(left), np.int64), []
            count, value = root[:, table.columns(chosen)], None
            for level in range(self.depth):
                if not level:
                    value = yield "sum", table.sums(chosen, node, 1, left)
                else:
                    # the smaller children, by the rows of all tasks
                    right = after[1::2] < after[::2]
                    small = np.arange(len(right)) * 2 + right
                    name = np.full(2 * len(right), -1)
                    name[small] = np.arange(len(right))
                    own = np.flatnonzero(name[node] >= 0)
                    part = table.part(own)
                    held = yield (
                        "sum",
                        np.stack([part.counts(chosen, name[node[own]], len(right)), part.sums(chosen, name[node[own]], len(right), left[own])]),
                    )
                    both = np.empty((2, 2 * len(right), held.shape[2]))
                    both[:, small] = held
                    both[:, small ^ 1] = np.stack([count, value]) - held
                    count, value = both
                c, s = _running(count, starts, bins), _running(value, starts, bins)
                first = slice(0, bins[0])  # every feature holds all rows of a node
                n, t = count[:, first].sum(1, keepdims=True), value[:, first].sum(1, keepdims=True)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = s**2 / c + (t - s) ** 2 / (n - c) - t**2 / n
                gain[~((c >= self.min_rows) & (n - c >= self.min_rows))] = -1.0
                best = gain.argmax(1)
                at = np.arange(len(best))
                split = gain[at, best] * unit**2 > 1e-12
                feature = np.where(split, features[best], 0)
                bound = np.where(split, best - starts[best], BINS)
                levels.append((feature, bound))
                node = node * 2 + table.beyond(feature, bound, node)
                n, t = n[:, 0], t[:, 0]
                after = np.stack([np.where(split, c[at, best], n), np.where(split, n - c[at, best], 0)], 1).ravel()
                sums = np.stack([np.where(split, s[at, best], t), np.where(split, t - s[at, best], 0)], 1).ravel()
            moved = np.rint(self.step_size * sums / np.maximum(1, after))
            left -= moved[node]
            self.splits.append(levels)
            self.leaves.append(moved * unit)
        spread = yield "sum", np.array([np.square(left * unit).sum()])
        self.training_error = float(spread[0]) / self.rows
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        """A row per feature."""
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)]).astype(np.uint8)

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned, out = self._binned(x), np.full(len(x), self.base)
        every = np.arange(len(x))
        for levels, value in zip(self.splits, self.leaves):
            node = np.zeros(len(x), np.int64)
            for feature, bound in levels:
                node = node * 2 + (binned[feature[node], every] > bound[node])
            out += value[node]
        return out


def _cells(x: np.ndarray, low: float, high: float) -> np.ndarray:
    if not high > low:
        return np.zeros(len(x), np.int64)
    return np.clip((x - low) / (high - low) * CELLS, 0, CELLS - 1).astype(np.int64)


def _edges(counts: np.ndarray, low: float, high: float) -> np.ndarray:
    """Upper ends of the cells that hold the quantiles; none where all values are equal."""
    upto = counts.cumsum()
    cells = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, BINS) / BINS, "left"))
    edges = low + (cells + 1) * (high - low) / CELLS
    return edges[(edges < high) & (cells < CELLS - 1)]


def _running(values: np.ndarray, starts: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Sums up to each bin of its feature."""
    total = values.cumsum(1)
    before = np.concatenate([np.zeros((len(total), 1)), total], 1)
    return total - before[:, starts]


class Histograms:
    """Counts and sums by (node, feature, bin) over rows of binned features.

    Features of two bins are read together: rows are counted by their pattern of zeros and
    ones, of which a few hundred occur in a calendar, and a product gives each feature's share.
    """

    def __init__(self, binned: np.ndarray, bins: list[int]):
        self.binned, self.bins = binned, np.array(bins)
        self.flags = np.flatnonzero(self.bins <= 2)[:62]
        self.places = np.concatenate([[0], self.bins.cumsum()])
        packed = np.zeros(binned.shape[1], np.int64)
        for k, j in enumerate(self.flags):
            packed |= binned[j].astype(np.int64) << k
        patterns, self.pattern = np.unique(packed, return_inverse=True)
        self.ones = (patterns[:, None] >> np.arange(len(self.flags)) & 1).astype(float)

    def part(self, rows: np.ndarray) -> Histograms:
        """These rows only."""
        other = object.__new__(Histograms)
        vars(other).update(vars(self))
        other.rows = rows
        return other

    rows: np.ndarray | None = None

    def layout(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each column of a histogram its feature's first column and feature; the bins of each feature."""
        bins = self.bins[chosen]
        first = np.concatenate([[0], bins.cumsum()[:-1]])
        return np.repeat(first, bins), np.repeat(chosen, bins), bins

    def columns(self, chosen: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(self.places[j], self.places[j + 1]) for j in chosen])

    def counts(self, chosen: np.ndarray, node: np.ndarray, nodes: int) -> np.ndarray:
        return self._filled(chosen, node, nodes, None)

    def sums(self, chosen: np.ndarray, node: np.ndarray, nodes: int, values: np.ndarray) -> np.ndarray:
        return self._filled(chosen, node, nodes, values)

    def _filled(self, chosen: np.ndarray, node: np.ndarray, nodes: int, values: np.ndarray | None) -> np.ndarray:
        def by(code: np.ndarray, codes: int) -> np.ndarray:
            code = code if self.rows is None else code[self.rows]
            return np.bincount(node * codes + code, values, nodes * codes).reshape(nodes, codes)

        out = []
        place = {int(j): k for k, j in enumerate(self.flags)}
        if any(int(j) in place for j in chosen):
            patterns = by(self.pattern, len(self.ones))
            ones, total = patterns @ self.ones, patterns.sum(1)
        for j in chosen.tolist():
            if j in place:
                one = ones[:, place[j]]
                out.append(np.stack([total - one, one], 1)[:, : self.bins[j]])
            else:
                out.append(by(self.binned[j], int(self.bins[j])))
        return np.concatenate(out, 1)

    def beyond(self, feature: np.ndarray, bound: np.ndarray, node: np.ndarray) -> np.ndarray:
        """For each row whether its bin of its node's feature is above the node's bound."""
        return self.binned[feature[node], np.arange(len(node))] > bound[node]


def alone(fit: Fit) -> Any:
    """Drive a fit whose rows are all here."""
    try:
        _, own = next(fit)
        while True:
            _, own = fit.send(own)
    except StopIteration as done:
        return done.value


def in_step(fits: Mapping[Any, Fit], gather: Callable[[str], Iterable[str]]) -> dict[Any, Any]:
    """Drive fits whose rows are spread over tasks, all of which call this; ``gather`` gives every task all tasks' messages.

    A message holds one request of each fit the task has rows of, so a level of all trees takes
    one exchange. It ends when no task has a request left.
    """
    found: dict[Any, Any] = {}
    asked: dict[Any, Request] = {k: next(f) for k, f in fits.items()}
    while True:
        said = [_read(m) for m in gather(_written(asked))]
        if not any(said):
            return found
        following: dict[Any, Request] = {}
        for k, (how, _) in asked.items():
            parts = np.stack([m[k][1] for m in said if k in m])
            try:
                following[k] = fits[k].send(parts.sum(0) if how == "sum" else parts.max(0))
            except StopIteration as done:
                found[k] = done.value
        asked = following


def _written(asked: Mapping[Any, Request]) -> str:
    return base64.b64encode(zlib.compress(pickle.dumps(dict(asked)), 1)).decode()


def _read(message: str) -> dict[Any, Request]:
    return pickle.loads(zlib.decompress(base64.b64decode(message)))


def moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums of products of the columns of x, ones and y: all that least squares needs, and sums of parts add up."""
    wide = np.column_stack([x, np.ones(len(x)), y])
    return wide.T @ wide


class Line:
    """Least squares with a small ridge, the same interface; ``solve`` fits it to the sums of any number of rows."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Line:
        return self.solve(moments(x, y))

    def solve(self, sums: np.ndarray) -> Line:
        """Also keeps what the sums say of the fit: errors, and the mean products of residual and feature."""
        if not np.isfinite(sums).all():
            raise ValueError("a training row has a null or infinite value")
        width = round(sums.size**0.5)
        wide = sums.reshape(width, width)
        rows = wide[-2, -2]
        self.weights = np.linalg.solve(wide[:-1, :-1] + 1e-6 * rows * np.eye(width - 1), wide[:-1, -1])
        self.rows = round(rows)
        self.constant_error = (wide[-1, -1] - wide[-2, -1] ** 2 / rows) / rows
        over = np.append(-self.weights, 1.0)
        self.training_error = over @ wide @ over / rows
        self.residual_products = (wide @ over)[:-1] / rows
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.ones(len(x))]) @ self.weights
