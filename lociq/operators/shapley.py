"""Shapley values of tree ensembles: what each feature adds to a row's margin, by the paths to the leaves.

A leaf's part in the expected margin, given the features of a set, is its value times one factor for each feature on its path: 1 or 0 (the row's value fits the path or
not) for known features, else the share of the training rows that went that way. Its Shapley values depend only on which features fit, so they are
computed once for each pattern of fits that a batch holds, with polynomials over the sizes of sets, and then looked up.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Step:
    """What a path asks of one feature: to lie above ``low`` and at most at ``high``, or in ``among``; ``share`` of the rows went this way."""

    low: float = -np.inf
    high: float = np.inf
    among: frozenset | None = None
    share: float = 1.0

    def fits(self, x: np.ndarray) -> np.ndarray:
        inside = (x > self.low) & (x <= self.high)
        return inside if self.among is None else inside & np.isin(x, list(self.among))


@dataclass
class Leaf:
    value: float
    steps: dict[int, Step] = field(default_factory=dict)


def _stats(node) -> float:
    return float(node.impurityStats().count())


def leaves_of(root, value, weight: float) -> list[Leaf]:
    """Leaves of a tree with their paths; ``value(node)`` is a leaf's value. The tree is walked on the driver, where the model is."""
    out = []
    todo = [(root, {})]
    while todo:
        node, steps = todo.pop()
        if not hasattr(node, "leftChild") or node.getClass().getSimpleName() == "LeafNode":
            out.append(Leaf(weight * value(node), steps))
            continue
        split, total = node.split(), _stats(node)
        f = int(split.featureIndex())
        for left in (True, False):
            child = node.leftChild() if left else node.rightChild()
            s = steps.get(f, Step())
            share = s.share * (_stats(child) / total if total else 0.5)
            if split.getClass().getSimpleName() == "ContinuousSplit":
                t = float(split.threshold())
                s = Step(s.low, min(s.high, t), s.among, share) if left else Step(max(s.low, t), s.high, s.among, share)
            else:
                own = frozenset(float(c) for c in (split.leftCategories() if left else split.rightCategories()))
                s = Step(s.low, s.high, own if s.among is None else s.among & own, share)
            todo.append((child, steps | {f: s}))
    return out


def ensemble(model) -> list[Leaf]:
    """Leaves of a fitted decision tree, forest or boosted model: their values add up to the margin (boosted), to the mean (regression), or to the probability of class 1."""
    name = type(model).__name__
    trees = getattr(model, "trees", None) or [model]
    weights = list(model.treeWeights) if "GBT" in name else [1 / len(trees)] * len(trees)

    def value(node) -> float:
        if "Classification" in name and "GBT" not in name:
            stats = list(node.impurityStats().stats())
            return stats[1] / sum(stats)
        return float(node.prediction())

    return [leaf for tree, w in zip(trees, weights, strict=True) for leaf in leaves_of(tree._java_obj.rootNode(), value, float(w))]


def leaf_values(leaf: Leaf, fits: np.ndarray) -> np.ndarray:
    """Shapley values (pattern, feature of the path) of a leaf, for patterns of fits (0 or 1)."""
    n = fits.shape[1]
    share = [s.share for s in leaf.steps.values()]
    weight = np.array([factorial(k) * factorial(n - 1 - k) / factorial(n) for k in range(n)])
    out = np.empty(fits.shape)
    for i in range(n):
        # sums over the sets of k other known features of the product of all other factors
        sets = np.zeros((len(fits), n))
        sets[:, 0] = 1
        for j in range(n):
            if j != i:
                grown = sets * share[j]
                grown[:, 1:] += sets[:, :-1] * fits[:, [j]]
                sets = grown
        out[:, i] = leaf.value * (fits[:, i] - share[i]) * (sets @ weight)
    return out


def _alike(leaves: list[Leaf], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of each kind that no path tells apart, and the kind of each row: each feature's values fall between the limits that paths set, and kinds are combinations of these."""
    kind = np.zeros(len(x), np.int64)
    for f in sorted({f for leaf in leaves for f in leaf.steps}):
        steps = [leaf.steps[f] for leaf in leaves if f in leaf.steps]
        limits = np.unique([t for s in steps for t in (s.low, s.high)])
        own = np.searchsorted(limits, x[:, f]) + np.isnan(x[:, f])  # nan, which fits no path, stands after all others
        if any(s.among is not None for s in steps):
            _, own = np.unique(x[:, f], return_inverse=True)
        kind = kind * (int(own.max(initial=0)) + 1) + own.reshape(-1)
        kind = np.unique(kind, return_inverse=True)[1].reshape(-1)  # stays below the number of rows
    _, first, kind = np.unique(kind, return_index=True, return_inverse=True)
    return first, kind.reshape(-1)


def values(leaves: list[Leaf], x: np.ndarray) -> tuple[np.ndarray, float]:
    """Shapley values (row, feature), and the expected margin. Leaves are asked once for all rows that no path tells apart."""
    first, kind = _alike(leaves, x)
    some = x[first]
    out = np.zeros(some.shape)
    for leaf in leaves:
        if leaf.steps:
            which = list(leaf.steps)
            places = np.arange(len(which))
            code = sum(s.fits(some[:, f]).astype(np.int64) << k for k, (f, s) in enumerate(leaf.steps.items()))
            pattern, at = np.unique(code, return_inverse=True)
            out[:, which] += leaf_values(leaf, (pattern[:, None] >> places & 1).astype(float))[at.reshape(-1)]
    return out[kind], sum(leaf.value * float(np.prod([s.share for s in leaf.steps.values()])) for leaf in leaves)


def tree_attributions(model, df: DataFrame, features: list[str], rows: int = 10_000) -> DataFrame:
    """Add phi_<feature> for each feature and phi_0 to the rows of ``df``: together they are the row's margin (see ``ensemble``).

    ``model`` is a fitted pipeline whose last stage is a tree ensemble over the vector column of its other stages, with a place for each of ``features``. Rows that
    those stages skip are left out. The leaves go to the tasks with the function; rows are never gathered.
    """
    last = model.stages[-1]
    leaves = ensemble(last)
    ready = df
    for stage in model.stages[:-1]:
        ready = stage.transform(ready)
    kept = [f"`{c}`" for c in df.columns]
    wide = ready.select(*kept, vector_to_array(last.getFeaturesCol()).alias("_x"))
    kind = ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), *(f"`phi_{f}` double" for f in features), "phi_0 double"])
    names = [*df.columns, *(f"phi_{f}" for f in features), "phi_0"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                x = part.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(features))
                phi, base = values(leaves, x)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(phi[:, k]) for k in range(len(features))), pa.array(np.full(part.num_rows, base))], names)

    return wide.mapInArrow(run, kind)


def importance(phi: DataFrame, features: list[str]) -> DataFrame:
    """Mean size of each feature's values: feature, mean_size."""
    return phi.agg(*(F.avg(F.abs(F.col(f"phi_{f}"))).alias(f) for f in features)).unpivot([], features, "feature", "mean_size")
