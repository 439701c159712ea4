"""The stratified split leaves the rows where they are; permuted rows are scored once."""

from pyspark.sql import functions as F

from tallyrisk.operators import models as ML
from tallyrisk.operators import split as SP


def test_rows_are_not_shuffled_by_class(spark):
    df = spark.range(4000).select("id", (F.col("id") % 2).cast("int").alias("label")).repartition(6).checkpoint()
    got = SP.stratified_split(df, "label", "id", 0.2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # as for a cut whose size is not known
    try:
        got.write.format("noop").mode("overwrite").save()
        stored = SP.stratified_split(df, "label", "id", 0.2).checkpoint(eager=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert stored.rdd.getNumPartitions() == 6
    assert min(stored.rdd.glom().map(len).collect()) > 400
    assert {tuple(r) for r in stored.groupBy("label", "split").count().collect()} == {
        (0, "test", 400), (0, "train", 1600), (1, "test", 400), (1, "train", 1600)}


def test_permuted_rows_are_scored_once(spark, monkeypatch):
    features = ["a", "b"]
    df = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double")
                                 .alias("b"), (F.col("id") % 7 > 3).cast("int").alias("label"))
    plans, seen = [], spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(a):
        seen.add(1)
        return a
    monkeypatch.setattr(ML, "predict_pd", lambda m, d, f: plans.append(d) or d.withColumn("pd", score("a")))
    got = {r.feature: r.importance for r in ML.permutation_importance(None, df, features, bucket_rows=50).collect()}
    assert got["a"] > 0.2 and got["b"] == 0
    assert len(plans) == 1 and seen.value == 400 * 3
