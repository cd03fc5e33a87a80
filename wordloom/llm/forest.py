"""A random forest of classification trees: each tree is grown in a task of its own on a bounded table."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Spec:
    trees: int = 32
    depth: int = 10
    leaf_rows: int = 3
    seed: int = 11


@dataclass
class Forest:
    """Nodes of all trees in a row: a row goes to ``left`` where its feature is at most ``cut``, else to ``left + 1``.

    ``left`` is -1 in a leaf; ``share`` is the share of positive training rows there.
    """

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    share: np.ndarray

    def probability(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            while (inner := self.left[at] >= 0).any():
                here, live = at[inner], np.flatnonzero(inner)
                at[live] = self.left[here] + (rows[live, self.feature[here]] > self.cut[here])
            total += self.share[at]
        return total / max(len(self.roots), 1)


def _best_split(x: np.ndarray, y: np.ndarray, w: np.ndarray, features: np.ndarray, leaf_rows: int) -> tuple[float, int, float]:
    """``(impurity, feature, cut)`` of the split with the lowest weighted Gini impurity; feature -1 if there is none."""
    best = (np.inf, -1, 0.0)
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        values, positive, weight = x[order, f], np.cumsum(y[order] * w[order]), np.cumsum(w[order])
        last = np.flatnonzero(values[1:] > values[:-1])
        last = last[(last + 1 >= leaf_rows) & (len(values) - last - 1 >= leaf_rows)]
        if not len(last):
            continue
        left, left_positive = weight[last], positive[last]
        right, right_positive = weight[-1] - left, positive[-1] - left_positive
        impurity = left_positive * (1 - left_positive / left) + right_positive * (1 - right_positive / right)
        k = int(np.argmin(impurity))
        if impurity[k] < best[0]:
            best = (float(impurity[k]), int(f), float((values[last[k]] + values[last[k] + 1]) / 2))
    return best


def grow(x: np.ndarray, y: np.ndarray, spec: Spec, tree: int) -> list[tuple[int, float, int, float]]:
    """One tree on a bootstrap sample, both classes of equal weight; at each node a random part of the features competes."""
    rng = np.random.default_rng((spec.seed, tree))
    drawn = rng.integers(0, len(x), len(x))
    x, y = x[drawn], y[drawn].astype(np.float64)
    positive = y.sum()
    w = np.where(y > 0, 0.5 / max(positive, 1), 0.5 / max(len(y) - positive, 1)) * len(y)
    tried = max(1, int(np.sqrt(x.shape[1])) + 1)
    nodes: list = [None]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        at, rows, depth = todo.pop()
        share = float((y[rows] * w[rows]).sum() / max(w[rows].sum(), 1e-12))
        nodes[at] = (0, 0.0, -1, share)
        if depth == spec.depth or len(rows) < 2 * spec.leaf_rows or share in (0.0, 1.0):
            continue
        features = rng.permutation(x.shape[1])[:tried]
        _, feature, cut = _best_split(x[rows], y[rows], w[rows], features, spec.leaf_rows)
        if feature < 0:
            continue
        goes_left = x[rows, feature] <= cut
        nodes[at] = (feature, cut, len(nodes), share)
        todo += [(len(nodes), rows[goes_left], depth + 1), (len(nodes) + 1, rows[~goes_left], depth + 1)]
        nodes += [None, None]
    return nodes


def fit(spark: SparkSession, x: np.ndarray, y: np.ndarray, spec: Spec = Spec()) -> Forest:
    """Grow the trees on the cluster; ``x`` and ``y`` are broadcast, so their caller bounds them.

    Without rows of both classes there are no trees and every probability is 0.
    """
    empty = np.zeros(0, np.int64)
    if not (y > 0).any() or (y > 0).all():
        return Forest(empty, empty, np.zeros(0), empty, np.zeros(0))
    shared = spark.sparkContext.broadcast((x, y))

    def run(batches):
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                nodes = grow(*shared.value, spec, tree)
                columns = [pa.array([tree] * len(nodes)), pa.array(range(len(nodes)), pa.int64())]
                columns += [pa.array([n[i] for n in nodes], kind) for i, kind in enumerate((pa.int64(), pa.float64(), pa.int64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "place", "feature", "cut", "left", "share"])

    ddl = "tree bigint, place bigint, feature bigint, cut double, left bigint, share double"
    rows = spark.range(spec.trees, numPartitions=spec.trees).mapInArrow(run, ddl).collect()  # at most 2 ** (depth + 1) a tree
    rows.sort(key=lambda r: (r.tree, r.place))
    roots = np.array([i for i, r in enumerate(rows) if r.place == 0], np.int64)
    base = np.repeat(roots, np.diff(np.append(roots, len(rows))))
    left = np.array([r.left for r in rows], np.int64)
    return Forest(roots, np.array([r.feature for r in rows], np.int64), np.array([r.cut for r in rows]),
                  np.where(left >= 0, left + base, -1), np.array([r.share for r in rows]))
