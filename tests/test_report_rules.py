"""Report sections (S-17) and coercion rules of the performance tape (M-12)."""

from pyspark.sql import functions as F

from tallyrisk.operators import validate as V
from tallyrisk.sources import files as FS
from tallyrisk.sources import tape as TP


def test_summary_sections(spark):
    report = spark.createDataFrame([("score_drift", "score", "psi", 0.3, "alert")],
                                   "check string, name string, metric string, value double, severity string")
    score = spark.createDataFrame([(0.1, 0.2, 0.3, 0.4)], "ref_p10 double, ref_p50 double, cur_p10 double, cur_p50 double")
    rolling = spark.createDataFrame([("2031-02", None, 5, 0), ("2031-01", 0.75, 9, 2)],
                                    "period string, auc double, n_obs long, n_defaults long")
    text = FS.summary_markdown(report, score=score, rolling=rolling, policy_version="v7").first()["markdown"]
    lines = text.split("\n")
    assert "Policy version: v7" in lines and "## Score percentiles" in lines and "## Rolling AUC" in lines
    assert lines.index("| 10 | 0.1 | 0.3 |") + 1 == lines.index("| 50 | 0.2 | 0.4 |")
    assert lines.index("| 2031-01 | 0.75 | 9 | 2 |") + 1 == lines.index("| 2031-02 |  | 5 | 0 |")
    plain = FS.summary_markdown(report).first()["markdown"]
    assert "Policy" not in plain and "percentiles" not in plain and plain in text
    empty = FS.summary_markdown(report, rolling=rolling.limit(0)).first()["markdown"]
    assert empty.rstrip().endswith("|---|---|---|---|")


def test_every_typed_performance_column_has_a_coercion_rule(spark):
    typed = sorted(TP.PERFORMANCE_TYPES)
    assert len(typed) == 19 and {r.column for r in V.PERFORMANCE_RULES if r.kind == "type"} == set(typed)
    row = {c: "x1" for c in typed} | {"loan_sequence_number": "L", "monthly_reporting_period": "012031"}
    good = {c: "1.5" for c in typed} | {"loan_sequence_number": "L", "monthly_reporting_period": "012031"}
    df = spark.createDataFrame([row, good], ", ".join(f"{c} string" for c in row))
    got = V.validate(df, V.PERFORMANCE_RULES).select("loan_age", "violations").collect()
    assert sorted(got[0].violations) == [f"{c}:type" for c in typed] and got[1].violations == []
    report = V.violation_report(df.withColumn("id", F.lit(7).cast("long")), V.PERFORMANCE_RULES, "id")
    assert {r.rule: (r.n_violations, r.first_id) for r in report.collect()} == {f"{c}:type": (1, 7) for c in typed}


def test_summary_reads_its_report_once(spark, tmp_path):
    rows = [("feature_drift", "a", "psi", 0.3, "alert"), ("perf_drift", "auc", "slope", None, "ok")]
    path = str(tmp_path / "report")
    spark.createDataFrame(rows, "check string, name string, metric string, value double, severity string").write.parquet(path)
    out = FS.summary_markdown(spark.read.parquet(path))
    assert out.inputFiles() == []    # stored: neither the lines nor the alerts go back to the source
    assert "| feature_drift | a | psi | 0.300000 | alert |" in out.first()["markdown"]


def test_performance_drift_takes_a_stored_rolling_auc(spark, tmp_path):
    from tallyrisk.operators import perf_drift as PD

    path = str(tmp_path / "scores")
    spark.createDataFrame([(f"2024-0{m}", i / 10, int(i % m == 0)) for m in range(1, 6) for i in range(10)],
                          "period string, pd double, label int").write.parquet(path)
    scores = spark.read.parquet(path)
    own = PD.perf_drift(scores)
    assert own.inputFiles() == []
    given = PD.perf_drift(scores, rolling=PD.rolling_auc(scores).checkpoint(eager=True))
    assert given.collect() == own.collect()
