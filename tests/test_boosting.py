"""Boosted trees against a plain learner, both ways of growing them, and Shapley values against subsets."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrisk.operators import attribution as A
from tallyrisk.operators import boosting as B
from tallyrisk.operators import models as ML

FEATURES = ["a", "b", "c", "d"]


def rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c, d = rng.gauss(0, 1), rng.choice([0.0, 1.0, 2.0]), rng.random(), rng.gauss(5, 2)
        y = int(rng.random() < 1 / (1 + math.exp(-(2 * a + b * c - 1))))
        out.append((i, None if i % 9 == 0 else a, b, None if i % 13 == 0 else c, d, y))
    return out


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(rows(200), "id long, a double, b double, c double, d double, label int").cache()


def _penalised(g, l1):
    return math.copysign(max(abs(g) - l1, 0), g)


def plain_tree(bins, g, h, columns, p):
    """Rows, not histograms; every split tried; returns {leaf rows: value} and the splits by node."""
    splits, values = {}, {}

    def grow(node, members, depth):
        sg, sh = sum(g[i] for i in members) / B.POINT, sum(h[i] for i in members) / B.POINT
        own = _penalised(sg, p.l1) ** 2 / (sh + p.l2)
        best = (1e-9, None)
        if depth < p.depth:
            for missing in (False, True):
                for f in columns:
                    if missing and not any(bins[i][f] == 0 for i in members):
                        continue
                    for cut in range(1, B.BINS - 1):
                        left = [i for i in members if (missing if bins[i][f] == 0 else bins[i][f] <= cut)]
                        gl, hl = sum(g[i] for i in left) / B.POINT, sum(h[i] for i in left) / B.POINT
                        if min(hl, sh - hl) < p.leaf:
                            continue
                        gain = (_penalised(gl, p.l1) ** 2 / (hl + p.l2)
                                + _penalised(sg - gl, p.l1) ** 2 / (sh - hl + p.l2) - own) / 2
                        if gain > best[0] + 1e-12:
                            best = (gain, (f, cut, missing, left))
        if best[1] is None:
            for i in members:
                values[i] = -p.step * _penalised(sg, p.l1) / (sh + p.l2)
            return
        f, cut, missing, left = best[1]
        splits[node] = f
        grow(2 * node + 1, left, depth + 1)
        grow(2 * node + 2, sorted(set(members) - set(left)), depth + 1)
    grow(0, list(range(len(bins))), 0)
    return splits, values


def test_trees_equal_a_plain_learner():
    data = rows(200)
    x = np.array([[np.nan if v is None else v for v in r[1:5]] for r in data])
    y = np.array([r[5] for r in data], np.int8)
    edges = [np.unique(np.nanquantile(x[:, j], np.arange(1, 12) / 12)) for j in range(4)]
    bins, keys = B.to_bins(x, edges), np.arange(200, dtype=np.uint64)
    p = B.Params(rounds=4, depth=3, step=0.3, columns=0.8, leaf=2.0, l1=0.3, l2=1.5)
    fit = B.Fit(5, p, -1)
    grown = B.grow(bins, y, keys, np.zeros(200, np.int8), fit, 1.7, 3)
    margin = np.zeros(200)
    for k in range(4):
        g, h = B.gradients(margin, y, 1.7)
        columns = B.column_sample(4, p.columns, 3, 5, k)
        assert len(columns) == 3
        splits, values = plain_tree(bins.tolist(), g.tolist(), h.tolist(), columns.tolist(), p)
        tree = fit.trees[k]
        assert {int(n): int(tree.feature[n]) for n in np.flatnonzero(tree.feature >= 0)} == splits
        margin += np.array([values[i] for i in range(200)])
        assert tree.value[B.leaves(tree, bins)] == pytest.approx([values[i] for i in range(200)])
    assert grown == pytest.approx(margin)


def test_both_ways_grow_the_same_trees(train, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 60)
    monkeypatch.setattr(B, "KEEP_ROUNDS", 2)
    monkeypatch.setattr(B, "HISTOGRAM_BYTES", 20_000)
    plans = [(B.Params(rounds=5, depth=2, step=0.3, rows=0.7, l1=0.1), 0), (B.Params(rounds=3, depth=3, leaf=2.0), 1),
             (B.Params(rounds=4, depth=3, step=0.2, columns=0.5), -1)]
    got = [B.fit_many(train.repartition(n), FEATURES, "label", plans, 3, 7, "id", None, limit)
           for n, limit in ((3, 1 << 30), (2, 0))]
    (near, near_auc, edges), (far, far_auc, _) = got
    assert near_auc == pytest.approx(far_auc) and set(near_auc) == {0, 1}
    assert [len(f.trees) for f in far] == [5, 3, 4]
    for a, b in zip(near[2].trees, far[2].trees):
        for name in ("feature", "cut", "missing_left", "value", "cover"):
            used = a.cover > 0
            assert np.array_equal(getattr(a, name)[used], getattr(b, name)[used]), name


def test_search(train):
    model, auc, params = ML.fit_boosted_trees(train, FEATURES, n_iter=3, id_col="id",
                                              search={"rounds": (5, 20), "depth": (2, 3)})
    assert 0.6 < auc < 1 and 5 <= params.rounds <= 20 and len(model.trees) == params.rounds
    scored = ML.predict_pd(model, train, FEATURES).select("pd", "label", "a", "b", "c", "d").toPandas()
    assert B.area_under_curve(scored.pd.to_numpy(), scored.label.to_numpy()) > auc
    bins = B.to_bins(scored[FEATURES].to_numpy(float), model.edges)
    assert scored.pd.to_numpy() == pytest.approx(1 / (1 + np.exp(-B.margins(model.trees, bins))))
    again = ML.fit_boosted_trees(train.repartition(5), FEATURES, n_iter=3, id_col="id",
                                 search={"rounds": (5, 20), "depth": (2, 3)})
    assert again[1] == auc and all(np.array_equal(a.value, b.value) for a, b in zip(model.trees, again[0].trees))


def test_odd_tables(spark):
    schema = "id long, a double, b double, c double, d double, label int"
    one = spark.createDataFrame([(i, 1.0, None, float(i), 2.0, 1) for i in range(20)], schema)
    model, auc, _ = ML.fit_boosted_trees(one, FEATURES, n_iter=2, id_col="id", search={"rounds": (2, 2)})
    assert len(model.trees) == 2 and auc == float("-inf")
    assert ML.predict_pd(model, one, FEATURES).filter("pd is null").count() == 0


def expected(tree, row, known, node=0):
    """The margin of one tree if only the features in ``known`` are."""
    f = int(tree.feature[node])
    if f < 0:
        return float(tree.value[node])
    kids = (2 * node + 1, 2 * node + 2)
    if f in known:
        left = tree.missing_left[node] if row[f] == 0 else row[f] <= tree.cut[node]
        return expected(tree, row, known, kids[0 if left else 1])
    return sum(tree.cover[k] / tree.cover[node] * expected(tree, row, known, k) for k in kids)


def test_attributions_equal_subset_enumeration(train):
    model = ML.fit_trees(train, FEATURES, B.Params(rounds=6, depth=4, step=0.3), id_col="id")
    got = A.tree_attributions(model, train.filter("id < 25")).toPandas()
    bins = B.to_bins(got[FEATURES].to_numpy(float), model.edges)
    for row, values in zip(bins, got.attributions):
        for j in range(4):
            others = [k for k in range(4) if k != j]
            want = 0.0
            for size in range(4):
                weight = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                for known in itertools.combinations(others, size):
                    want += weight * sum(expected(t, row, {*known, j}) - expected(t, row, set(known)) for t in model.trees)
            assert values[j] == pytest.approx(want, abs=1e-9)
    total = np.stack(got.attributions).sum(axis=1) + A.base_value(model)
    assert total == pytest.approx(B.margins(model.trees, bins))


def test_mean_attribution_ranks_what_drives_the_label(train):
    model = ML.fit_trees(train, FEATURES, B.Params(rounds=20, depth=3), id_col="id")
    top = A.mean_abs_tree_attribution(model, train).collect()
    assert top[0].feature == "a" and [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)
    assert {r.feature for r in A.mean_abs_tree_attribution(model, train, 2).collect()} <= set(FEATURES)


def test_model_keys():
    assert ML.trainer("sklearn-rf") is ML.fit_random_forest and ML.trainer("sklearn-logreg") is ML.fit_logreg
    assert ML.trainer("prophet").__name__ == "seasonal_forecast"
    with pytest.raises(ValueError, match="unknown model"):
        ML.trainer("xgb")


def test_missing_column_is_an_error(train):
    with pytest.raises(Exception):
        ML.fit_trees(train.drop("a"), FEATURES, B.Params(rounds=1)).transform(train.select(F.lit(1))).count()


def test_only_the_smaller_children_are_added_up():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, B.BINS, (500, 4)).astype(np.uint8)
    g, h = (rng.integers(-9, 9, 500) * 1.0, rng.integers(1, 9, 500) * 1.0)
    part = B.Sample(bins, np.array([0, 2, 3]), g, h)
    assert part.cell.nbytes == 500 * 3        # a byte a cell, whatever the sums
    parents = np.array([1, 2])
    node = np.where(bins[:, 0] < 40, np.where(bins[:, 1] < 9, 3, 4), 2)   # node 2 is a leaf
    above = part.histograms(np.where(node == 2, 1, 0), 2)
    added = []
    part.histograms, whole = (lambda slot, n: added.append((slot >= 0).sum()) or whole(slot, n)), part.histograms
    got = part.children(node, np.array([3, 4]), parents, above)
    assert added == [min((node == 3).sum(), (node == 4).sum())]
    assert np.array_equal(got, whole(np.where(node == 2, -1, node - 3), 2))
    totals = part.totals(np.where(node == 2, -1, node - 3), 2)
    assert np.array_equal(totals.sum(axis=2)[:, 0], got[:, 0].sum(axis=1))
