"""Small gradient-boosted trees over tables: logistic loss, binned features, calibrated thresholds."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TREES = 40
DEPTH = 3
BINS = 32
RATE = 0.3
SMOOTH = 1.0
#: Slopes are rounded to this part, scores to that.
STEPS = 1 << 20
LEVELS = 10_000


class Tree(NamedTuple):
    """A complete tree: inner node ``i`` has children ``2 i + 1`` and ``2 i + 2``."""

    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray


class Boosted(NamedTuple):
    trees: list[Tree]
    start: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of each row."""
        total = np.full(len(rows), self.start)
        for tree in self.trees:
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                right = rows[np.arange(len(rows)), tree.feature[node]] > tree.limit[node]
                node = 2 * node + 1 + right
            total += tree.leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def _split(binned: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[float, int, int]:
    """Best gain, feature and bin of a node's rows."""
    best = (1e-6, 0, BINS)
    whole = grad.sum() ** 2 / (hess.sum() + SMOOTH)
    for feature in range(binned.shape[1]):
        g = np.cumsum(np.bincount(binned[:, feature], grad, BINS + 1))
        h = np.cumsum(np.bincount(binned[:, feature], hess, BINS + 1))
        gain = g**2 / (h + SMOOTH) + (g[-1] - g) ** 2 / (h[-1] - h + SMOOTH) - whole
        at = int(np.argmax(gain[:-1]))
        if gain[at] > best[0]:
            best = (float(gain[at]), feature, at)
    return best


def fit(rows: np.ndarray, truth: np.ndarray) -> Boosted:
    """Fit to ``truth`` (0 or 1), on arrays; ``fit_table`` is the same over a table."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(cut, column) for cut, column in zip(cuts, rows.T)], 1)
    share = np.clip(truth.mean(), 1e-4, 1 - 1e-4)
    start = float(np.log(share / (1 - share)))
    total, trees = np.full(len(rows), start), []
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-total))
        grad, hess = truth - chance, chance * (1 - chance)
        inner = 2**DEPTH - 1
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(rows), np.int64)
        for number in range(inner):
            own = np.flatnonzero(node == number)
            if len(own):
                _, feature[number], at = _split(binned[own], grad[own], hess[own])
                cut = cuts[feature[number]]
                limit[number] = cut[at] if at < len(cut) else np.inf
                node[own] = 2 * number + 1 + (rows[own, feature[number]] > limit[number])
        grads, hesses = (np.bincount(node - inner, part, 2**DEPTH) for part in (grad, hess))
        leaf = RATE * grads / (hesses + SMOOTH)
        total += leaf[node - inner]
        trees.append(Tree(feature, limit, leaf))
    return Boosted(trees, start)


def threshold(scores: np.ndarray, truth: np.ndarray, precision: float, least: int) -> float:
    """The lowest score from which on at least ``precision`` of ``least`` or more rows are true."""
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
    last = np.ones(len(order), bool)
    last[:-1] = scores[order][1:] != scores[order][:-1]
    good = np.flatnonzero((right >= precision) & last & (np.arange(1, len(order) + 1) >= least))
    return float(scores[order][good[-1]]) if len(good) else float("inf")


def _best(grads: np.ndarray, hesses: np.ndarray) -> tuple[int, int]:
    """Feature and bin of a node's best split, from its sums by feature and bin; all rows go left if none gains."""
    best, feature, at = 1e-6, 0, BINS
    for number, (g, h) in enumerate(zip(np.cumsum(grads, 1), np.cumsum(hesses, 1))):
        whole = g[-1] ** 2 / (h[-1] + SMOOTH)
        gain = g**2 / (h + SMOOTH) + (g[-1] - g) ** 2 / (h[-1] - h + SMOOTH) - whole
        place = int(np.argmax(gain[:-1]))
        if gain[place] > best:
            best, feature, at = float(gain[place]), number, place
    return feature, at


def quantile_cuts(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Where the bins of each feature of ``rows (values array<double>)`` end: quantiles of all rows, by mergeable summaries."""
    places = [float(place) for place in np.linspace(0, 1, BINS + 1)[1:-1]]
    found = rows.agg(*(F.percentile_approx(F.get("values", F.lit(at)), places, 10_000) for at in range(width))).first()
    return [np.unique(np.array(column, float)) for column in found]


_BINNED = pa.schema([("bins", pa.binary()), ("kind", pa.int32()), ("held", pa.bool_()), ("truth", pa.bool_())])


def binned(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """``bins, kind, held, n, hits``: the different rows of ``rows (values, kind, held, truth)`` after binning.

    ``n`` rows fell together, of which ``hits`` are true. Trees tell no more apart.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
            bins = np.stack([np.searchsorted(cut, column) for cut, column in zip(cuts, values.T)], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row.tobytes() for row in bins], pa.binary()), *map(batch.column, ("kind", "held", "truth"))],
                schema=_BINNED)

    found = rows.mapInArrow(run, "bins binary, kind int, held boolean, truth boolean")
    return found.groupBy("bins", "kind", "held").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("truth").cast("bigint")).alias("hits"))


def _bins_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)


def _walk(bins: np.ndarray, feature: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The node that each row reaches."""
    node = np.zeros(len(bins), np.int64)
    for _ in range(depth):
        node = 2 * node + 1 + (bins[np.arange(len(bins)), feature[node]] > at[node])
    return node


def _chances(bins: np.ndarray, start: float, trees: list[tuple]) -> np.ndarray:
    total = np.full(len(bins), start)
    for feature, at, leaf in trees:
        total += leaf[_walk(bins, feature, at, DEPTH) - (2**DEPTH - 1)]
    return 1 / (1 + np.exp(-total))


def _summed(start: float, trees: list[tuple], feature: np.ndarray, at: np.ndarray, level: int, width: int) -> Callable:
    """Of a task's rows, sums of the slopes and curvatures by node of the level, feature and bin, as one row."""
    cells = 2**level * (BINS + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, width, cells))
        for batch in batches:
            bins, n = _bins_of(batch, width), batch.column("n").to_numpy().astype(float)
            chance = _chances(bins, start, trees)
            # multiples of 1 / STEPS add up exactly, so the order of rows is no matter
            chance, curve = (np.rint(part * STEPS) / STEPS for part in (chance, chance * (1 - chance)))
            parts = batch.column("hits").to_numpy() - n * chance, n * curve
            first = (_walk(bins, feature, at, level) - (2**level - 1)) * (BINS + 1)
            for number in range(width):
                place = first + bins[:, number]
                for total, part in zip(sums, parts):
                    total[number] += np.bincount(place, part, cells)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([sums.tobytes()], pa.binary())})

    return run


def fit_table(rows: DataFrame, cuts: list[np.ndarray]) -> tuple[Boosted, Callable[[np.ndarray], np.ndarray]]:
    """Fit to all ``rows (bins, n, hits)``, which are stored: the trees, and the same as a function of binned rows.

    Each level of a tree is one pass. A task sends its sums by node, feature and bin, whose number the rows do not change.
    """
    width = len(cuts)
    size = rows.agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).first()
    share = np.clip(size.hits / size.n, 1e-4, 1 - 1e-4)
    start = float(np.log(share / (1 - share)))
    plain: list[tuple] = []
    trees = []
    for _ in range(TREES):
        inner = 2**DEPTH - 1
        feature, at, leaf = np.zeros(inner, np.int64), np.full(inner, BINS), np.zeros(2**DEPTH)
        for level in range(DEPTH):
            found = rows.select("bins", "n", "hits").mapInArrow(
                _summed(start, plain, feature, at, level, width), "sums binary").collect()
            sums = sum(np.frombuffer(row.sums).reshape(2, width, 2**level, BINS + 1) for row in found)
            for place in range(2**level):
                node, own = 2**level - 1 + place, sums[:, :, place]
                feature[node], at[node] = _best(*own)
                if level == DEPTH - 1:
                    part = own[:, feature[node]]
                    left = part[:, :at[node] + 1].sum(1)
                    for side, (g, h) in enumerate((left, part.sum(1) - left)):
                        leaf[2 * place + side] = RATE * g / (h + SMOOTH)
        plain.append((feature, at, leaf))
        limit = [cuts[one][bin] if bin < len(cuts[one]) else np.inf for one, bin in zip(feature, at)]
        trees.append(Tree(feature, np.array(limit), leaf))
    return Boosted(trees, start), lambda bins: _chances(bins, start, plain)


def lowest_levels(rows: DataFrame, chances: Callable[[np.ndarray], np.ndarray], width: int, precision: float, least: int) -> dict[int, float]:
    """By kind, the lowest score from which on ``precision`` of all ``rows (bins, kind, n, hits)``, ``least`` or more, are true.

    Scores are counted in ``LEVELS`` steps. A kind without such a score is left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level = np.floor(chances(_bins_of(batch, width)) * LEVELS).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {"kind": batch.column("kind"), "level": pa.array(level), "n": batch.column("n"), "hits": batch.column("hits")})

    counted = rows.select("bins", "kind", "n", "hits").mapInArrow(run, "kind int, level bigint, n bigint, hits bigint")
    found: dict[int, float] = {}
    totals: dict[int, tuple[int, int]] = {}
    for row in counted.groupBy("kind", "level").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).orderBy(
            "kind", F.desc("level")).collect():
        n, hits = totals.get(row.kind, (0, 0))
        totals[row.kind] = n, hits = n + row.n, hits + row.hits
        if n >= least and hits >= precision * n:
            found[row.kind] = row.level / LEVELS
    return found
