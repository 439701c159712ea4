"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    use = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        moved = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        use.append((i, moved, [math.floor(256 * float(np.float32(x))) for x in v]))
    out, seen = [], set()
    for i, label, v in use:
        if i is None or i % 50 or (i, label, tuple(v)) in seen:
            continue
        seen.add((i, label, tuple(v)))
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, k == label) for j, k, w in use if j != i)
        for ps, none, j, same in [x for x in scored if x[3]][:5]:
            fit = [x for x in scored if not x[3] and 50 * -ps <= 100 * -x[0] <= 95 * -ps][:3]
            out += [(i, None if none else j, r + 1, None if x[1] else x[2], -ps, -x[0]) for r, x in enumerate(fit)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
                   for r in df.collect()), key=str)


def random_rows(n, dims, seed, copies=0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.5) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        label = rng.choice([0, 1, 1, 1, 2, 3])
        rows.append((i, [c + rng.gauss(0, 0.4) for c in centres[label]], label))
    twin = rows[3][1]
    return rows + [(n + i, twin, rng.choice([1, 2])) for i in range(copies)]


@pytest.mark.parametrize("dims,copies,block", [(24, 0, 32_768), (24, 150, 40), (3, 200, 64), (70, 0, 50)])
def test_against_brute_force(spark, dims, copies, block):
    rows = random_rows(400, dims, dims, copies)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("clash"), "v": F.lit(1), "block": F.lit(2)})
    want = brute(rows)
    assert want and found(N.mine(df, block_rows=block)) == want


def test_odd_rows(spark):
    rows = random_rows(120, 8, 9)
    odd = [(None, rows[5][1], 1), (200, None, 1), (201, [0.1] * 8, None), (202, [0.1, None] + [0.0] * 6, 1),
           (203, [float("nan")] + [0.0] * 7, 2), (204, [float("inf")] * 8, 1), (205, [], 1), (206, [0.5, 0.25], 2),
           (207, [0.0] * 8, 1), (250, [0.3] * 8, 77), (300, [], 1), rows[0], rows[50], rows[50], rows[60], (-50, rows[1][1], -3)]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    assert found(N.mine(df, block_rows=30)) == brute(rows + odd)


def test_large_components_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [float(np.float32(rng.uniform(-1e5, 1e5))) for _ in range(10)], i % 3) for i in range(150)]
    assert found(N.mine(spark.createDataFrame(rows, SCHEMA), block_rows=40)) == brute(rows)
    huge = [(i, [1e12, 1e12], 1) for i in range(4)] + [(100, [1e12, 1e12], 1)]
    with pytest.raises(Exception, match="64 bits"):
        N.mine(spark.createDataFrame(huge, SCHEMA)).collect()


@pytest.mark.parametrize("share", [0.9, 0.5, 0.1, -2.0])
def test_threshold_join_is_complete(share):
    rng = np.random.default_rng(2)
    v = rng.integers(-50, 50, (300, 40))
    v[:100] //= 10
    block = N.Block(np.arange(300), np.zeros(300, bool), np.zeros(300, int), v)
    a = rng.integers(-50, 50, (20, 40))[:, block.dims]
    rest = N._rest_norms(a)
    least = share * rest[:, 0] * block.rest[:, 0].mean()
    at, row, score = N.threshold_join(block, a, rest, least)
    exact = a @ block.vectors.T
    assert np.array_equal(exact[at, row], score)
    assert sorted(zip(at, row)) == sorted(zip(*np.nonzero(exact >= least[:, None])))


def test_empty(spark):
    assert N.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert N.mine(spark.createDataFrame([(50, [0.1], 1), (51, [0.1], 2)], SCHEMA)).count() == 0
