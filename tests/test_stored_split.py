"""The models' split is found once and stored; no pass of a fit repeats it."""

from pyspark.sql import functions as F

from tallyrisk.operators import models as ML
from tallyrisk.plans import q_models


def _frame(spark):
    x = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(97)).cast("double").alias(f) for i, f in enumerate(q_models.FEATS)]
    label = (F.pmod(F.xxhash64("id", F.lit(99)), F.lit(3)) == 0).cast("int").alias("label")
    return spark.range(300).select("id", *x, label)


def test_passes_over_the_split_read_stored_rows(spark, monkeypatch):
    monkeypatch.setattr(q_models, "training_frame", lambda s, d: _frame(s))
    train, test = q_models._split(spark, "")
    for part in (train, test):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Window" not in plan and "Aggregate" not in plan
    assert test.count() == 60 and train.count() == 240
    assert train.join(test, "id").count() == 0


def test_batch_score_builds_the_training_frame_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(q_models, "training_frame", lambda s, d: calls.append(d) or _frame(s))
    monkeypatch.setattr(ML, "LOGREG_MAX_ITER", 5)
    rows = q_models.q_batch_score(spark, "x").collect()
    assert calls == ["x"] and sorted(r.id for r in rows) == list(range(300))
