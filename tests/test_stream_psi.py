"""X-2 by foreachBatch: replays change nothing, and the result equals batch PSI per window."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyrisk.operators import drift as D
from tallyrisk.streaming import stream as ST

SCHEMA = "ts timestamp, a double, b double"


def rows(n, seed):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    out = [(start + dt.timedelta(minutes=rng.randint(0, 4 * 24 * 60 - 1)), rng.gauss(0, 1),
            rng.choice([1.0, 2.0, 3.0, None, float("nan")])) for _ in range(n)]
    return out + [(None, 1.0, 1.0), (start + dt.timedelta(days=9), 1e6, 1e6)]


def test_replay_and_batch_equality(spark, tmp_path):
    ref = spark.createDataFrame(rows(300, 1)[:-1], SCHEMA)
    events = spark.createDataFrame(rows(400, 2), SCHEMA).repartition(5)
    landing, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    events.write.parquet(landing)
    edges = D.quantile_edges(ref, ["a", "b"])
    hist = D.histogram(D.two_sides(ref, None, ["a", "b"]), edges)
    shares = hist.select("feature", "bin", (F.col("rn") / F.sum("rn").over(Window.partitionBy("feature"))).alias("ref_share"))
    frozen = {r.feature: list(r.edges) for r in edges.collect()}

    def run(name):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
        out = ST.write_feature_psi(stream, frozen, shares, sink, str(tmp_path / name), "1 day")
        return sorted((r.window_start, r.feature, None if r.psi is None else round(r.psi, 9), r.n_in_range, r.out_of_range)
                      for r in out.collect())
    first = run("one")
    assert run("two") == first and len(first) == 10    # the same batches once more, into the same sink
    day = dt.datetime(2024, 1, 2)
    for feature in ("a", "b"):
        got = next(r for r in first if r[0] == day and r[1] == feature)
        own = events.filter((F.col("ts") >= day) & (F.col("ts") < day + dt.timedelta(days=1)))
        want = D.drift_core(ref, own, [feature]).first()
        assert got[2] == pytest.approx(want.psi) and got[3] + got[4] == want.n_cur
    late = next(r for r in first if r[0] == dt.datetime(2024, 1, 10) and r[1] == "a")
    assert late[2] is None and late[3:] == (0, 1)


def test_landed_files_follow_the_partitions(spark, tmp_path):
    """Two batches, whatever the number of files: no four tasks write a large table."""
    for parts, files in ((9, 9), (1, 4)):
        landing = str(tmp_path / str(parts))
        assert ST.land_files(spark.range(0, 900, 1, parts), landing) == -(-files // 2)
        landed = spark.read.parquet(landing)
        assert len(landed.inputFiles()) == files and landed.count() == 900


def test_frozen_edges_and_shares(spark):
    from tallyrisk.plans.q_streaming import _frozen

    ref = spark.createDataFrame(rows(300, 1), SCHEMA).withColumn("none", F.lit(None).cast("double"))
    edges, shares = _frozen(ref, ["a", "b", "none"])
    want = D.quantile_edges(ref, ["a", "b", "none"])
    assert edges == {r.feature: r.edges for r in want.collect()} and set(edges) == {"a", "b"}
    hist = D.histogram(D.two_sides(ref, None, ["a", "b", "none"]), want).collect()
    total = {f: sum(r.rn for r in hist if r.feature == f) for f in edges}
    assert {(r.feature, r.bin): r.ref_share for r in shares.collect()} == {
        (r.feature, r.bin): r.rn / total[r.feature] for r in hist}
    empty, none = _frozen(ref.limit(0), ["a"])
    assert empty == {} and none.count() == 0
