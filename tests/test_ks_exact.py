"""Exact two-sample KS p-values against all interleavings, and the drift core on odd inputs."""

import itertools

import numpy as np
import pytest

from tallyrisk.operators import drift as D


def brute_p(d, n, m):
    """Share of all interleavings of n and m values whose largest gap is at least d."""
    hit = total = 0
    for at in itertools.combinations(range(n + m), n):
        first = set(at)
        i = j = 0
        gap = 0.0
        for k in range(n + m):
            i, j = (i + 1, j) if k in first else (i, j + 1)
            gap = max(gap, abs(i / n - j / m))
        total += 1
        hit += gap >= d - 1e-9
    return hit / total


@pytest.mark.parametrize("n,m", [(1, 1), (1, 5), (3, 4), (4, 4), (5, 8), (8, 6), (8, 8)])
def test_lattice_pvalue_is_exact(n, m):
    gaps = {abs(i / n - j / m) for i in range(n + 1) for j in range(m + 1)}
    for d in sorted(gaps):
        assert D._lattice_pvalue(d, n, m) == pytest.approx(brute_p(d, n, m), rel=1e-12)


def test_small_p_keep_their_digits():
    """All of one sample before the other: 2 of C(2n, n) interleavings."""
    from math import comb
    assert D._lattice_pvalue(1.0, 60, 60) == pytest.approx(2 / comb(120, 60), rel=1e-10)
    assert D._lattice_pvalue(0.0, 60, 60) == 1.0


def gap_of(a, b):
    points = np.unique(np.concatenate([a, b]))
    return max(abs((a <= x).mean() - (b <= x).mean()) for x in points)


def test_exact_and_series_meet(spark, monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 1500).round(2), rng.normal(0.1, 1, 900).round(2)
    ref, cur = (spark.createDataFrame([(float(x),) for x in v], "x double") for v in (a, b))
    exact = D.ks_table(ref, cur, ["x"]).first()
    monkeypatch.setattr(D, "EXACT_KS_ROWS", 1499)
    series = D.ks_table(ref, cur, ["x"]).first()
    assert exact.ks_statistic == pytest.approx(gap_of(a, b)) == series.ks_statistic
    assert exact.ks_p_value == pytest.approx(D._lattice_pvalue(gap_of(a, b), 1500, 900))
    assert exact.ks_p_value != series.ks_p_value and exact.ks_p_value == pytest.approx(series.ks_p_value, rel=0.1)


def test_profile_quantiles_and_bins(spark):
    rng = np.random.default_rng(4)
    a, b = rng.choice([0.0, 0.0, 1.5, 2.0, 7.0], 400), rng.normal(2, 3, 300)
    frames = [spark.createDataFrame([(float(x), None) for x in v] + [(None, None), (float("nan"), None)],
                                    "x double, none double") for v in (a, b)]
    edges = np.unique(np.quantile(a, np.arange(11) / 10))
    got = {r.feature: r for r in D.drift_core(*frames, ["x", "none"], percentile_probs=[0.1, 0.5]).collect()}
    assert got["x"].ref_pct == pytest.approx(np.quantile(a, [0.1, 0.5])) and got["x"].cur_pct == pytest.approx(
        np.quantile(b, [0.1, 0.5]))
    assert (got["x"].n_ref, got["x"].n_cur) == (400, 300)
    r, c = np.histogram(a, edges)[0], np.histogram(b, edges)[0]
    p, q = np.maximum(c / c.sum(), 1e-8), np.maximum(r / r.sum(), 1e-8)
    assert got["x"].psi == pytest.approx(((p - q) * np.log(p / q)).sum())
    assert got["x"].out_of_range_share == pytest.approx(1 - c.sum() / 300)
    assert (got["none"].n_ref, got["none"].psi, got["none"].ks_statistic, got["none"].ks_p_value) == (0, 0, 0, 1)
    hist = {(x.bin): (x.rn, x.cn) for x in D.histogram(
        D.two_sides(*frames, ["x"]), D.quantile_edges(frames[0], ["x"])).collect()}
    assert {k: v for k, v in hist.items()} == {i: (x, y) for i, (x, y) in enumerate(zip(r, c)) if x or y}
    # One side empty, one value only, nothing in range.
    empty = frames[0].limit(0)
    assert D.drift_core(frames[0], empty, ["x"]).first().psi == 0
    one = spark.createDataFrame([(5.0,)] * 4, "x double")
    assert D.drift_core(one, frames[1].select("x"), ["x"]).first().psi == 0
    far = spark.createDataFrame([(99.0,)], "x double")
    assert D.drift_core(frames[0].select("x"), far, ["x"]).first().psi is None
