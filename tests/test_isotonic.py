"""Isotonic regression by ranges against the sequential algorithm and Spark's own."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from tallyrisk.operators.isotonic import isotonic_blocks, isotonic_map, pool_adjacent


def minimax(points):
    """The fit by its definition: the largest of the least means of all runs around each point."""
    s = np.concatenate([[0], np.cumsum([y * w for _, y, w in points])])
    w = np.concatenate([[0], np.cumsum([w for *_, w in points])])
    n = len(points)
    return [max(min((s[k + 1] - s[j]) / (w[k + 1] - w[j]) for k in range(i, n)) for j in range(i + 1)) for i in range(n)]


def sample(kind, n, rng):
    if kind == "tied":
        return [(rng.randint(0, n // 3) / 7, float(rng.random() < 0.3), float(rng.randint(1, 3))) for _ in range(n)]
    if kind == "falling":
        return [(float(i), float(n - i), 1.0) for i in range(n)]
    if kind == "saw":     # falls over far more than a range, then rises, again and again
        return [(float(i), float(i // 100 * 60 - i % 100), 1.0) for i in range(n)]
    return [(float(i), float(i), 1.0) for i in range(n)]


@pytest.mark.parametrize("kind", ["tied", "falling", "saw", "rising"])
def test_ranges_equal_the_sequential_algorithm(spark, kind):
    rows = sample(kind, 300, random.Random(3))
    df = spark.createDataFrame(rows, "x double, y double, w double")
    sums: dict = {}
    for x, y, w in rows:
        s, total = sums.get(x, (0.0, 0.0))
        sums[x] = (s + y * w, total + w)
    points = [(x, s / w, w) for x, (s, w) in sorted(sums.items())]
    fitted = isotonic_blocks(df, "x", "y", "w", rows_per_range=40)
    blocks = sorted(map(tuple, fitted.collect()))
    xs = np.array([p[0] for p in points])
    one = pool_adjacent(xs, xs, np.array([p[1] * p[2] for p in points]), np.array([p[2] for p in points]))
    assert [b[:2] for b in blocks] == list(zip(one[0], one[1]))
    assert all(math.isclose(b[2] / b[3], s / w, abs_tol=1e-9) for b, s, w in zip(blocks, one[2], one[3]))
    want = minimax(points)
    fit = isotonic_map(fitted, per_array=16)
    got = {r.x: r.fit for r in fit(df, "x", "fit").collect()}
    assert all(math.isclose(got[x], v, abs_tol=1e-9) for (x, *_), v in zip(points, want))


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_values_between_blocks_are_those_of_sparks_own_fit(spark, broadcast):
    rows = sample("tied", 400, random.Random(5))
    df = spark.createDataFrame(rows, "x double, y double, w double")
    own = IsotonicRegression(featuresCol="x", labelCol="y", weightCol="w", predictionCol="own").fit(df)
    probes = spark.createDataFrame([(i / 50 - 1.0, "kept") for i in range(1200)], "x double, _at string")
    fit = isotonic_map(isotonic_blocks(df, "x", "y", "w", rows_per_range=32), per_array=5, max_broadcast=broadcast)
    probes = probes.withColumnRenamed("_at", "note")
    rows = own.transform(fit(probes, "x", "mine")).collect()
    assert len(rows) == 1200 and {r.note for r in rows} == {"kept"}
    assert all(math.isclose(r.own, r.mine, abs_tol=1e-9) for r in rows)


def test_edge_cases(spark):
    none = spark.createDataFrame([], "x double, y double, w double")
    assert isotonic_blocks(none, "x", "y").count() == 0
    probe = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    assert [r.f for r in isotonic_map(isotonic_blocks(none, "x", "y"))(probe, "x", "f").collect()] == [None] * 3
    odd = spark.createDataFrame([(None, 1.0, 1.0), (float("nan"), 1.0, 1.0), (0.5, None, 1.0), (0.5, 9.0, 0.0),
                                 (0.5, 0.25, 2.0), (2.0, 1.0, 1.0)], "x double, y double, w double")
    fit = isotonic_map(isotonic_blocks(odd, "x", "y", "w"))
    got = [r.f for r in fit(spark.createDataFrame([(0.0,), (0.5,), (1.25,), (2.0,), (3.0,), (None,)], "x double"),
                            "x", "f").orderBy(F.col("x").asc_nulls_last()).collect()]
    assert got == [0.25, 0.25, 0.625, 1.0, 1.0, None]
    with pytest.raises(ValueError):
        isotonic_blocks(odd, "x", "y", rows_per_range=4)
