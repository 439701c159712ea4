"""Landed and ingested tapes stay small: few files per quarter, compressed tapes read as plain ones."""

from pyspark.sql import functions as F

from tallyrisk.sources import tape as TP


def _combined(spark, n):
    at = {v: k for k, v in TP.COMBINED_PERF_POSITIONS.items()} | {v: k for k, v in TP.COMBINED_ORIG_POSITIONS.items()}
    value = {"loan_sequence_number": F.concat(F.lit("L"), F.col("id").cast("string")), "monthly_reporting_period": F.lit("012001"),
             "credit_score": F.lit("700"), "current_actual_upb": (F.col("id") * 10).cast("string"), "channel": F.lit(" ")}
    cols = [value.get(at.get(i), F.lit(None).cast("string")).alias(f"p{i}") for i in range(TP.COMBINED_WIDTH)]
    return spark.range(n).select(*cols, F.concat(F.lit("200"), (F.col("id") % 5).cast("string"), F.lit("Q1")).alias("quarter"))


def test_origination_has_few_files_per_quarter(spark, tmp_path):
    names = [f"p{i}" for i in range(TP.COMBINED_WIDTH)]
    TP.write_tape(_combined(spark, 2000), names, f"{tmp_path}/tape", "quarter")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # as many tasks as a large table has
    try:
        out = TP.ingest_all(spark, [], [], [f"{tmp_path}/tape"], f"{tmp_path}/out")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert out["origination"].count() == 2000 and out["performance"].count() == 2000
    assert out["origination"].select("quarter").distinct().count() == 5
    assert len(list((tmp_path / "out" / "origination").rglob("*.parquet"))) == 5


def test_a_compressed_tape_is_read_as_a_plain_one(spark, tmp_path):
    names, got = [f"p{i}" for i in range(TP.COMBINED_WIDTH)], {}
    for codec in ("none", "gzip"):
        TP.write_tape(_combined(spark, 500), names, f"{tmp_path}/{codec}", "quarter", codec)
        o, p = TP.split_combined_tape(spark, f"{tmp_path}/{codec}")
        got[codec] = sorted(map(str, o.collect())), sorted(map(str, p.collect()))
    assert got["none"] == got["gzip"] and len(got["gzip"][0]) == 500
    size = {c: sum(f.stat().st_size for f in (tmp_path / c).rglob("part-*")) for c in got}
    assert size["gzip"] < size["none"] / 5


def test_a_compressed_tape_without_a_quarter_has_the_plain_stem(spark):
    names = spark.createDataFrame([("/t/part-1.c000.csv.gz",), ("/t/part-1.c000.csv",), ("/t/x2001q3.gz",),
                                   ("/t/plain",)], "_file string")
    got = names.withColumn("_file_name", F.substring_index("_file", "/", -1)).select(TP.quarter_of().alias("q"))
    assert [r.q for r in got.collect()] == ["PART-1.C000", "PART-1.C000", "2001Q3", "PLAIN"]
