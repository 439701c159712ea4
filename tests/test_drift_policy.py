"""Drift statistics (M-1..M-6) and policy decisions (P-12, N-2, A-3..A-5) on literal fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrisk.operators import drift as D
from tallyrisk.operators import policy as P


def _frame(spark, values, col="value"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{col} double")


def test_psi_stable_and_drifted(spark):
    rng = np.random.default_rng(0)
    ref = _frame(spark, rng.normal(700, 50, 2000))
    same = _frame(spark, rng.normal(700, 50, 2000))
    shifted = _frame(spark, rng.normal(550, 80, 2000))
    ok = D.feature_drift(ref, same, ["value"]).first()
    bad = D.feature_drift(ref, shifted, ["value"]).first()
    assert ok["psi"] < 0.10 and ok["ks_p_value"] > 0.05 and ok["severity"] in ("ok", "warning")
    assert bad["psi"] >= 0.25 and bad["ks_p_value"] < 0.05 and bad["severity"] == "alert"
    assert 0 <= ok["ks_statistic"] <= 1


def test_psi_empty_and_nulls(spark):
    ref = _frame(spark, [1.0, 2.0, None, 3.0])
    empty = _frame(spark, [])
    assert D.feature_drift(ref, empty, ["value"]).first()["psi"] == 0.0
    cur = _frame(spark, [1.1, 2.1, None, 3.1])
    assert D.feature_drift(ref, cur, ["value"]).first()["psi"] >= 0


def test_missing_feature_skipped(spark):
    ref = spark.createDataFrame([(1.0,)], "credit_score double")
    out = D.feature_drift(ref, ref, ["credit_score", "orig_ltv"]).collect()
    assert [r["feature"] for r in out] == ["credit_score"]


def test_percentiles_match_numpy(spark):
    vals = list(np.random.default_rng(3).random(101))
    got = D.percentiles(_frame(spark, vals), "value").first()
    want = np.percentile(vals, [10, 25, 50, 75, 90])
    assert all(abs(got[f"p{p}"] - round(w, 6)) < 1e-6 for p, w in zip([10, 25, 50, 75, 90], want))


def _scores(spark, pds):
    return spark.createDataFrame([(i, float(p), 0) for i, p in enumerate(pds)], "id long, pd double, label int")


def test_decision_zones(spark):
    df = _scores(spark, [0.099999, 0.10, 0.25])
    got = [r["d"] for r in df.orderBy("id").select(P.decide(F.col("pd"), 0.10, 0.25).alias("d")).collect()]
    assert got == ["approve", "review", "decline"]


def test_capacity_keeps_highest_and_ties_by_order(spark):
    pol = [P.Policy("p", 0.10, 0.90, 0.2)]
    pds = [0.01, 0.02, 0.5, 0.6, 0.3, 0.7, 0.03, 0.04, 0.05, 0.06]  # review band of 4, cap 2
    dec = {r["id"]: r["decision"] for r in P.decide_with_capacity(_scores(spark, pds), pol).collect()}
    assert [i for i, d in dec.items() if d == "review"] == [3, 5] or sorted(
        i for i, d in dec.items() if d == "review") == [3, 5]
    assert dec[2] == "approve" and dec[4] == "approve"
    ties = _scores(spark, [0.5, 0.5, 0.5, 0.01])  # n=4, cap .25 → one review slot
    dec = {r["id"]: r["decision"] for r in P.decide_with_capacity(
        ties, [P.Policy("t", 0.10, 0.90, 0.25)]).collect()}
    assert dec[0] == "review" and dec[1] == "approve" and dec[2] == "approve"


def test_capacity_floor_minimum_one(spark):
    dec = P.decide_with_capacity(_scores(spark, [0.5, 0.6, 0.01]), [P.Policy("m", 0.1, 0.9, 0.1)])
    assert dec.where(F.col("decision") == "review").count() == 1


def test_invalid_policy():
    with pytest.raises(ValueError):
        P.Policy("bad", 0.3, 0.2)
    with pytest.raises(ValueError):
        P.Policy("bad", 0.1, 0.2, 0.0)


def test_expected_loss(spark):
    df = spark.createDataFrame([(0, 0.1, 0), (1, 0.2, 1), (2, 0.5, 0), (3, 0.6, 1)],
                               "id long, pd double, label int")
    m = P.compare_policies(df, [P.Policy("x", 0.3, 0.4)], lgd=0.5).first()
    assert m["n_approved"] == 2 and abs(m["expected_loss_rate"] - 0.0375) < 1e-9
    assert m["n_approved"] + m["n_review"] + m["n_declined"] == m["n_total"]


def test_capacity_filled_exactly_above_cut(spark):
    pds = [0.5, 0.5, 0.4, 0.4, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06]  # n=10, cap .2 → 2 slots
    dec = {r["id"]: r["decision"] for r in P.decide_with_capacity(
        _scores(spark, pds), [P.Policy("k0", 0.10, 0.90, 0.2)]).collect()}
    assert [dec[i] for i in range(4)] == ["review", "review", "approve", "approve"]


def test_metrics_from_distinct_scores_equal_the_decided_rows(spark):
    import random

    rnd = random.Random(5)
    rows = [(i, rnd.choice([None, *[j / 40 for j in range(40)]]), rnd.choice([0, 1, None])) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, pd double, label int")
    pols = [P.Policy("a", 0.05, 0.15, 0.05), P.Policy("b", 0.1, 0.9, 0.3), P.Policy("c", 0.2, 0.4),
            P.Policy("d", 0.1, 0.95, 0.001), P.Policy("e", 0.3, 0.4, 1.0)]
    for frame, label in ((df, "label"), (df, None), (df.where("false"), "label")):
        want = P.policy_metrics(P.decide_with_capacity(frame, pols, extra_cols=["label"]), label_col=label)
        got = P.policy_metrics_of_scores(frame, pols, label_col=label)
        assert got.columns == want.columns
        assert sorted(got.collect(), key=lambda r: r.policy) == sorted(want.collect(), key=lambda r: r.policy)
