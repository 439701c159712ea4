"""Fitted models: factors of a row do not depend on its batch; the seasonal model finds planted structure."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyrisk.operators import models as ML
from tallyrisk.operators.forecast import seasonal_forecast

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def train(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        a, b, c = rng.gauss(5, 2), rng.gauss(0, 1), rng.random()
        y = int(rng.random() < 1 / (1 + math.exp(-(a - 5 - 2 * b))))
        rows.append((i, None if i % 17 == 0 else a, b, c, y))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label int").cache()


@pytest.fixture(scope="module")
def logreg(train):
    return ML.fit_logreg(train, FEATURES)


def test_one_row_scores_as_in_a_batch(train, logreg):
    terms = ML.fitted_terms(logreg, FEATURES)
    whole = {r.id: r for r in ML.batch_score(logreg, train, FEATURES, terms).collect()}
    for i in (0, 5, 17):
        alone = ML.batch_score(logreg, train.filter(F.col("id") == i), FEATURES, terms).first()
        assert alone.pd == pytest.approx(whole[i].pd) and alone.factors == whole[i].factors
    assert {f.name for f in whole[0].factors} == set(FEATURES)


def test_factors_explain_the_score(train, logreg):
    """Log-odds = intercept + sum of all contributions."""
    terms = ML.fitted_terms(logreg, FEATURES)
    intercept = logreg.stages[-1].intercept
    for r in ML.batch_score(logreg, train.limit(30), FEATURES, terms, top_n=3).collect():
        assert math.log(r.pd / (1 - r.pd)) == pytest.approx(intercept + sum(f.value for f in r.factors), abs=1e-6)


def test_tree_factors_are_the_global_importances(train):
    forest = ML.fit_random_forest(train, FEATURES, n_trees=10, min_leaf=5)
    got = ML.batch_score(forest, train.limit(3), FEATURES, top_n=2).collect()
    best = [r.feature for r in ML.global_importance(forest, FEATURES).collect()][:2]
    assert all([f.name for f in r.factors] == best for r in got)


def test_permutation_importance(train, logreg):
    got = {r.feature: r.importance for r in ML.permutation_importance(logreg, train, FEATURES, bucket_rows=50).collect()}
    assert got["b"] > got["c"] and got["a"] > got["c"] and abs(got["c"]) < 0.05
    one_class = train.filter("label = 1")
    assert all(r.importance is None for r in ML.permutation_importance(logreg, one_class, FEATURES).collect())


@pytest.mark.parametrize("method", ["isotonic", "isotonic_ranges", "sigmoid"])
def test_calibration_is_monotone_and_leaves_the_score(train, logreg, method):
    scored = ML.predict_pd(logreg, train, FEATURES).select("id", "pd", "label")
    rows = sorted((r.pd, r.pd_cal) for r in ML.calibrate(logreg, train, FEATURES, method=method)(scored).collect())
    assert all(0 <= c <= 1 for _, c in rows)
    assert all(a[1] <= b[1] + 1e-9 for a, b in zip(rows, rows[1:]))
    assert [p for p, _ in rows] == sorted(r.pd for r in scored.collect())


def test_seasonal_forecast_on_a_planted_series(spark):
    rng = random.Random(2)
    rows = []
    for k in range(72):
        d = dt.date(2015 + k // 12, k % 12 + 1, 1)
        trend = 0.10 + 0.001 * k + (0.003 * (k - 40) if k > 40 else 0)
        rows.append((d, trend + 0.02 * math.sin(2 * math.pi * d.month / 12) + rng.gauss(0, 0.005)))
    ts = spark.createDataFrame(rows, "ds date, y double")
    out = {str(r.ds): r for r in seasonal_forecast(ts, horizon=12).collect()}
    history = [(y, out[str(d)].yhat) for d, y in rows]
    mae = sum(abs(y - p) for y, p in history) / len(history)
    mean = sum(y for y, _ in history) / len(history)
    assert 0.003 <= mae <= 0.008 < sum(abs(y - mean) for y, _ in history) / len(history)
    assert len(out) == 84 and len({round(r.yhat, 6) for r in out.values()}) > 12
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in out.values())
    with pytest.raises(ValueError):
        seasonal_forecast(ts.limit(1))


def test_seasonal_forecast_of_many_segments(spark):
    """Every segment equals the fit of its own series; null segments, gaps and repeated months included."""
    rng = random.Random(8)
    rows = []
    for seg in [None, "", *[f"s{i}" for i in range(40)]]:
        start, n = rng.randint(0, 30), rng.choice([1, 2, 3, 20, 50])
        for k in range(n):
            m = start + k
            if n > 10 and k % 7 == 5:
                continue
            rows.append((seg, dt.date(2010 + m // 12, m % 12 + 1, 1), 0.2 + 0.004 * k + 0.03 * math.sin(m / 2)))
    rows += [("s1", rows[0][1], None), ("s2", None, 0.5), rows[-1]]
    ts = spark.createDataFrame(rows, "seg string, ds date, y double")
    got = {}
    for r in seasonal_forecast(ts, horizon=5, group_cols=["seg"]).collect():
        got.setdefault(r.seg, []).append((r.ds, r.yhat, r.yhat_lower, r.yhat_upper, r.mae))
    for seg in {r[0] for r in rows}:
        own = ts.filter(F.col("seg").eqNullSafe(F.lit(seg))).select("ds", "y")
        if own.filter("ds is not null and y is not null").select("ds").distinct().count() < 2:
            assert seg not in got
            continue
        if seg in (None, "", "s0", "s7", rows[-1][0]):
            assert sorted(got[seg]) == sorted(tuple(r) for r in seasonal_forecast(own, horizon=5).collect())
        y = {d: [v for s, e, v in rows if s == seg and e == d and v is not None] for d, *_ in got[seg]}
        errors = [abs(sum(v) / len(v) - p) for (d, p, *_), v in ((g, y[g[0]]) for g in got[seg]) if v]
        assert got[seg][0][4] == pytest.approx(sum(errors) / len(errors))


def test_registered_boosted_trees_search_is_the_reference_search(spark, monkeypatch):
    import inspect

    from tallyrisk.plans import q_models as QM
    asked = []

    class Stop(Exception):
        pass

    def seen(*args, **named):
        call = inspect.signature(fit).bind(*args, **named)
        call.apply_defaults()
        asked.append(call.arguments)
        raise Stop
    fit = ML.fit_boosted_trees
    monkeypatch.setattr(ML, "fit_boosted_trees", seen)
    monkeypatch.setattr(QM, "_split", lambda *_: (None, None))
    with pytest.raises(Stop):
        QM.q_pd_boosted_trees(spark, "")
    assert (asked[0]["n_iter"], asked[0]["folds"], asked[0]["search"]) == (25, 3, None)
    draws = ML.search_draws(25)
    assert all(100 <= p.rounds <= 600 and 3 <= p.depth <= 9 and 0.5 <= p.l2 <= 5 and 0 <= p.l1 <= 1 for p in draws)
    assert max(p.rounds for p in draws) > 500 and {p.depth for p in draws} >= {3, 9}
