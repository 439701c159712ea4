"""Distributed prefix sums and quantiles vs plain computations; AUC / metrics invariants."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyrisk.operators import metrics as M
from tallyrisk.operators.ranking import cumulative, exact_quantiles


def _data(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    g = rng.integers(0, 3, n)
    v = np.round(rng.normal(0, 1, n), 2)  # ties on purpose
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * v))).astype(int)
    return spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(g, v, y)],
                                 "g int, v double, y int"), g, v, y


def test_cumulative_matches_plain_window(spark):
    df, *_ = _data(spark)
    got = cumulative(df.select("g", "v", F.lit(1).alias("c")), ["g"], "v", ["c"], buckets=8)
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c")).select(
        "g", "v", F.sum("c").over(w).alias("cum_c"))
    a = sorted(tuple(r) for r in got.select("g", "v", "cum_c").collect())
    b = sorted(tuple(r) for r in ref.collect())
    assert a == b


def test_exact_quantiles_match_numpy(spark):
    df, g, v, _ = _data(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["q_index"]): r["value"] for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    for k in range(3):
        want = np.percentile(v[g == k], [p * 100 for p in probs])
        for i, w_ in enumerate(want):
            assert abs(got[(k, i)] - w_) < 1e-9


def _brute_auc(s, y):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])


def test_auc_brute_force_and_symmetry(spark):
    df, _, v, y = _data(spark, n=600)
    a = M.auc(df, score_col="v", label_col="y").first()["auc"]
    assert abs(a - _brute_auc(v, y)) < 1e-6
    flipped = M.auc(df.withColumn("v", -F.col("v")), score_col="v", label_col="y").first()["auc"]
    assert abs(a + flipped - 1) < 2e-6


def test_single_class_auc_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "pd double, label int")
    assert M.auc(df).first()["auc"] is None


def test_binary_metrics_sane(spark):
    df, _, v, y = _data(spark, n=800)
    p = df.select((1 / (1 + F.exp(-2 * F.col("v")))).alias("pd"), F.col("y").alias("label"))
    r = M.binary_metrics(p).first()
    assert 0.5 < r["auc_roc"] <= 1 and 0 < r["average_precision"] <= 1
    assert 0 <= r["best_f1"] <= 1 and r["n_samples"] == 800
    rate = y.mean()
    assert r["brier_score"] < rate * (1 - rate)


def test_results_do_not_depend_on_the_broadcast_bound(spark, monkeypatch):
    from tallyrisk.operators import macro, perf_drift, ranking

    rows = [(f"2020-{i % 9 + 1:02d}", (i * 37 % 101) / 101, i * 13 % 5 % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "period string, pd double, label int")
    series = spark.createDataFrame([("2020-01", 1.0), ("2020-05", 2.0)], "period string, rate double")

    def results():
        got = [perf_drift.rolling_auc(df), exact_quantiles(df, ["period"], "pd", [0.1, 0.5]),
               macro.macro_join(df.withColumn("month", F.col("period")), series, "month", F.col("month"))
               .select("month", "pd", "label", "rate")]
        return [sorted(map(tuple, g.collect()), key=repr) for g in got]
    few = results()
    for module in (ranking, perf_drift, macro):
        monkeypatch.setattr(module, "MAX_BROADCAST_ROWS", 8)
    assert results() == few
