"""Mergeable quantile profiles against the exact statistics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrisk.operators import drift as D
from tallyrisk.operators import sketches as S


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(7)
    rows = [(["a", "b", "c"][i % 3], float(x), float(y)) for i, (x, y) in enumerate(
        zip(rng.normal(650, 60, 20_000), rng.integers(0, 30, 20_000)))]
    rows += [("a", None, float("nan")), ("d", None, None)]
    return spark.createDataFrame(rows, "period string, x double, y double").repartition(5)


def _off(data, value, p):
    """How far the ranks that ``value`` covers in ``data`` are from ``p``, as a share."""
    low, high = np.mean(data < value), np.mean(data <= value)
    return max(low - p, p - high, 0.0)


def test_merged_periods_keep_the_rank_bound(values):
    k = 200
    data = {f: np.array([r[0] for r in values.select(f).dropna().collect() if r[0] == r[0]]) for f in "xy"}
    kept = S.sketch_profile(values, ["x", "y"], F.col("period"), k)
    assert {(r.period, r.feature) for r in kept.collect()} == {(p, f) for p in "abc" for f in "xy"}
    for profile in (kept, S.sketch_profile(values, ["x", "y"], k=k)):
        for r in S.sketch_percentiles(profile, k=k).collect():
            assert r.n == 20_000
            for p in D.REPORT_PERCENTILES:
                assert _off(data[r.feature], r[f"p{p}"], p / 100) <= 2 * S.rank_error(k)


def test_a_profile_below_k_is_exact(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    r = S.sketch_percentiles(S.sketch_profile(df, ["x"])).first()
    assert [r[f"p{p}"] for p in D.REPORT_PERCENTILES] == [float(p) for p in D.REPORT_PERCENTILES]
    assert S.sketch_percentiles(S.sketch_profile(df.where("x < 0"), ["x"])).count() == 0


def test_psi_of_profiles_is_near_the_exact_one(spark, values):
    moved = values.withColumn("x", F.col("x") + 30)
    got = {r.feature: r for r in S.sketch_psi(S.sketch_profile(values, ["x"], F.col("period")),
                                             S.sketch_profile(moved, ["x", "y"], F.col("period"))).collect()}
    exact = D.psi_table(values, moved, ["x"]).first()
    assert set(got) == {"x"} and got["x"].n_ref == got["x"].n_cur == 20_000
    assert exact["psi"] > 0.1 and abs(got["x"].psi - exact["psi"]) < 0.1 * exact["psi"]
    same = S.sketch_profile(values, ["x"])
    assert S.sketch_psi(same, same).first().psi < 1e-9


def test_constant_feature(spark):
    df = spark.createDataFrame([(1.0,)] * 50, "x double")
    one = S.sketch_profile(df, ["x"])
    assert abs(S.sketch_psi(one, one).first().psi) < 1e-12
