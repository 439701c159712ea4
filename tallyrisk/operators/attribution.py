"""Path-dependent Shapley values of boosted trees (L-17).

A leaf with value v is reached through features i, each with a share z_i (product of the cover shares of the
branches taken at its splits) and, for a row, o_i (1 if the row goes that way at all of them). Without knowing
feature i a row goes on with the share z_i, so v counts with the product of o_i over the known features and z_i
over the others. The Shapley weights k! (m - 1 - k)! / m! are the integrals of t^k (1 - t)^(m - 1 - k),
hence the leaf gives feature j

    v (o_j - z_j) * integral over t in (0, 1) of the product over i != j of (o_i t + z_i (1 - t)),

and a Gauss rule of m / 2 points integrates that polynomial exactly. Rows differ only by the bits o, so each leaf
has a table over its 2^m patterns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .boosting import BINS, BoostedModel, Tree


@dataclass
class Leaf:
    features: list[int]      # on the path, each once
    passes: np.ndarray       # (features, bins): whether a bin goes the leaf's way at all splits
    gains: np.ndarray        # (patterns, features): attribution by pattern of the bits o
    mean: float              # value times the share of rows that reach the leaf


def _gains(value: float, shares: np.ndarray) -> np.ndarray:
    m = len(shares)
    t, w = np.polynomial.legendre.leggauss(m // 2 + 1)
    t, w = (t + 1) / 2, w / 2
    o = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)
    factor = o[:, :, None] * t + shares[None, :, None] * (1 - t)
    rest = factor.prod(axis=1, keepdims=True) / factor
    return value * (o - shares) * (rest * w).sum(axis=2)


def tree_leaves(tree: Tree) -> list[Leaf]:
    out = []

    def walk(node: int, passes: dict[int, np.ndarray], shares: dict[int, float]):
        f = int(tree.feature[node])
        if f < 0:
            order = sorted(passes)
            z = np.array([shares[i] for i in order])
            table = np.array([passes[i] for i in order]).reshape(len(order), BINS)
            out.append(Leaf(order, table, _gains(tree.value[node], z), float(tree.value[node] * z.prod())))
            return
        left = np.arange(BINS) <= tree.cut[node]
        left[0] = tree.missing_left[node]
        for child, way in ((2 * node + 1, left), (2 * node + 2, ~left)):
            share = tree.cover[child] / tree.cover[node] if tree.cover[node] else 0.5
            walk(child, passes | {f: passes.get(f, True) & way}, shares | {f: shares.get(f, 1.0) * share})
    walk(0, {}, {})
    return out


def explain(leaves: list[Leaf], bins: np.ndarray) -> np.ndarray:
    """Attributions (rows x features); with the base value they sum to the margin."""
    out = np.zeros(bins.shape)
    for leaf in leaves:
        pattern = np.zeros(len(bins), np.int64)
        for i, f in enumerate(leaf.features):
            pattern |= leaf.passes[i][bins[:, f]].astype(np.int64) << i
        got = leaf.gains[pattern]
        for i, f in enumerate(leaf.features):
            out[:, f] += got[:, i]
    return out


def base_value(model: BoostedModel) -> float:
    """The margin that is expected without knowing any feature."""
    return sum(leaf.mean for t in model.trees for leaf in tree_leaves(t))


def tree_attributions(model: BoostedModel, df: DataFrame, out: str = "attributions") -> DataFrame:
    """``df`` with an array of one attribution per model feature (margin units). The leaf tables are built
    once per task; rows travel in Arrow batches."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def attribution(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = shared.value
        leaves = [leaf for t in model.trees for leaf in tree_leaves(t)]
        for frame in batches:
            yield pd.Series(list(explain(leaves, model.bins_of(frame))))
    return df.withColumn(out, attribution(F.struct(*model.inputs())))


def mean_abs_tree_attribution(model: BoostedModel, df: DataFrame, max_display: int = 20) -> DataFrame:
    """Mean absolute attribution per feature over all rows, largest first."""
    rows = tree_attributions(model, df.select(*model.features)).select("attributions")
    means = rows.agg(*[F.avg(F.abs(F.get("attributions", F.lit(i)))).alias(f) for i, f in enumerate(model.features)])
    long = means.unpivot([], model.features, "feature", "importance")
    return long.orderBy(F.col("importance").desc(), "feature").limit(max_display)
