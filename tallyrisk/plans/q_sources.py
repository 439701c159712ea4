"""Queries for sources and sinks (S-1..S-17, W-2, U-1). Each one lands data that
Spark derives from the driver's tables in the shared checkpoint folder, then reads it
back through the operator under test, so the work grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import normalize_blanks
from ..operators import drift as D
from ..operators import perf_drift as PD
from ..session import scratch_path
from ..sources import files as FS
from ..sources import series as SR
from ..sources import tape as TP
from . import bindings as B
from .catalog import query
from .oracle_views import blank, with_views
from .q_features import _CHECKS_SQL, _ORIG_FEATURES_SQL, _SUMMARY_SQL, _TAPE_STR, q_feature_table
from .q_labels import _LABEL_SQL


def _landed_orig_tape(spark, d) -> str:
    path = scratch_path(spark, "orig-tape")
    TP.write_tape(B.orig_tape(spark, d), TP.ORIGINATION_COLUMNS, path, partition_col="quarter")
    return path


_NORM = {"norm": "SELECT loan_id, " + ", ".join(f"{blank(c)} AS {c}" for c in _TAPE_STR)
         + " FROM v_orig_tape", "checks": _CHECKS_SQL,
         "nv": "SELECT loan_id, count(rule) AS n FROM checks GROUP BY loan_id"}


@query("tape_round_trip", with_views("""
SELECT o.loan_sequence_number, o.quarter, o.credit_score, o.orig_upb, o.orig_loan_term, o.first_payment_date,
       o.first_payment_month AS period_month, CAST(coalesce(nv.n, 0) AS INTEGER) AS n_violations
FROM v_orig o LEFT JOIN nv USING (loan_id)""", "v_orig", extra=_NORM, dates=["period_month"]))
def q_tape_round_trip(spark, d):
    """S-1 + S-2 + S-6: tape landed per quarter, ingested to typed Parquet, read back."""
    src = _landed_orig_tape(spark, d)
    out = TP.ingest_tape(spark, src, "origination", scratch_path(spark, "orig-parquet"))
    return out.select("loan_sequence_number", "quarter", "credit_score", "orig_upb", "orig_loan_term",
                      "first_payment_date", "period_month",
                      F.size("violations").cast("int").alias("n_violations"))


@query("quarter_prune", with_views(
    "SELECT loan_sequence_number, quarter FROM v_orig WHERE quarter IN ('1996Q1', '1996Q2')", "v_orig"))
def q_quarter_prune(spark, d):
    """S-6 + W-2: only the wanted quarters are ingested (filter is case-insensitive)."""
    src = _landed_orig_tape(spark, d)
    out = TP.ingest_tape(spark, src, "origination", scratch_path(spark, "orig-q"), ["1996q1", "1996Q2"])
    return out.select("loan_sequence_number", "quarter")


def _landed_combined(spark, d):
    """The combined tape, one folder per origination quarter."""
    perf = B.perf_tape(spark, d)
    orig = B.orig_tape(spark, d).drop("quarter")
    j = perf.join(orig.drop("loan_sequence_number"), "loan_id", "inner")
    slots = {}
    for c, i in TP.COMBINED_ORIG_POSITIONS.items():
        if c in j.columns and c not in ("current_delinquency_status", "modification_flag"):
            slots[i] = F.col(c)
    for c, i in TP.COMBINED_PERF_POSITIONS.items():
        slots[i] = F.col(c)
    o = B.read(spark, d, "orders").select(
        "o_orderkey", F.concat(F.year("o_orderdate").cast("string"), F.lit("Q"),
                               F.quarter("o_orderdate").cast("string")).alias("quarter"))
    j = j.join(o, j.loan_id == o.o_orderkey, "left")
    cols = [(slots[i] if i in slots else F.lit(None).cast("string")).alias(f"p{i}")
            for i in range(TP.COMBINED_WIDTH)]
    path = scratch_path(spark, "combined")
    TP.write_tape(j.select(*cols, "quarter"), [f"p{i}" for i in range(TP.COMBINED_WIDTH)], path, "quarter", "gzip")
    return path


def _combined(spark, d):
    return TP.split_combined_tape(spark, _landed_combined(spark, d))


_PERF_OUT = ["loan_sequence_number", "monthly_reporting_period", "current_actual_upb",
             "current_delinquency_status", "loan_age", "remaining_months_to_legal_maturity",
             "modification_flag", "current_interest_rate"]


@query("combined_split_performance", with_views(
    "SELECT " + ", ".join(f"{blank(c)} AS {c}" for c in _PERF_OUT)
    + " FROM v_perf_tape WHERE loan_id IN (SELECT loan_id FROM v_orig_tape)", "v_perf_tape", "v_orig_tape"))
def q_combined_split_performance(spark, d):
    """S-4: every combined row → one performance row (by position)."""
    _, perf = _combined(spark, d)
    return normalize_blanks(perf.select(*_PERF_OUT))


_ORIG_OUT = ["loan_sequence_number", "channel", "orig_interest_rate", "orig_upb", "orig_loan_term",
             "first_payment_date", "maturity_date", "orig_ltv", "orig_cltv", "num_borrowers", "orig_dti",
             "credit_score", "first_time_homebuyer_flag", "occupancy_status", "property_type", "num_units",
             "loan_purpose", "property_state", "mi_pct", "amortization_type", "super_conforming_flag",
             "ppm_flag"]


@query("combined_split_origination", with_views(
    "SELECT " + ", ".join(f"{blank(c)} AS {c}" for c in _ORIG_OUT)
    + " FROM v_orig_tape WHERE loan_id IN (SELECT loan_id FROM v_perf_tape)", "v_perf_tape", "v_orig_tape"))
def q_combined_split_origination(spark, d):
    """S-4 + P-6: the first combined row per loan → one origination row (by position)."""
    orig, _ = _combined(spark, d)
    return normalize_blanks(orig.select(*_ORIG_OUT))


@query("ingest_all")
def q_ingest_all(spark, d):
    """S-5 (rows only): no classic tapes present → the combined tape is split and ingested."""
    perf = B.perf_tape(spark, d)
    path = scratch_path(spark, "combined-all")
    orig = B.orig_tape(spark, d).drop("quarter")
    j = perf.join(orig.drop("loan_sequence_number"), "loan_id", "inner")
    slots = {i: F.col(c) for c, i in TP.COMBINED_PERF_POSITIONS.items()}
    for c, i in TP.COMBINED_ORIG_POSITIONS.items():
        if c in j.columns and i not in slots:
            slots[i] = F.col(c)
    cols = [(slots[i] if i in slots else F.lit(None).cast("string")).alias(f"p{i}")
            for i in range(TP.COMBINED_WIDTH)]
    # 110 columns, most of them empty: as plain text the tape takes about ten times the tables' bytes.
    TP.write_tape(j.select(*cols), [f"p{i}" for i in range(TP.COMBINED_WIDTH)], path, compression="gzip")
    out = TP.ingest_all(spark, [], [], [path], scratch_path(spark, "ingest-all"))
    return out["performance"].select("loan_sequence_number", "monthly_reporting_period", "current_actual_upb",
                                     "quarter", F.size("violations").alias("n_violations"))


@query("ingest_all_quarters", with_views(
    """SELECT p.loan_sequence_number, p.monthly_reporting_period, TRY_CAST(trim(p.current_actual_upb) AS DOUBLE)
         AS current_actual_upb, CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter
       FROM v_perf_tape p JOIN orders ON o_orderkey = p.loan_id
       WHERE p.loan_id IN (SELECT loan_id FROM v_orig_tape)""", "v_perf_tape", "v_orig_tape"))
def q_ingest_all_quarters(spark, d):
    """S-5: no classic tapes present → the combined tape is split and ingested by quarter, performance side."""
    out = TP.ingest_all(spark, [], [], [_landed_combined(spark, d)], scratch_path(spark, "ingest-quarters"))
    return out["performance"].select("loan_sequence_number", "monthly_reporting_period", "current_actual_upb", "quarter")


@query("read_csv_source", with_views("SELECT id, pd, label, period FROM v_score", "v_score"))
def q_read_csv_source(spark, d):
    """S-7: ``csv:<path>`` source (header, inferred types)."""
    path = scratch_path(spark, "scores-csv")
    B.scores(spark, d).write.mode("overwrite").option("header", "true").csv(path)
    df = FS.load_source(spark, f"csv:{path}")
    return df.select(F.col("id").cast("bigint"), F.col("pd").cast("double"),
                     F.col("label").cast("int"), F.col("period").cast("string"))


@query("read_parquet_source", with_views("SELECT id, pd, label, period FROM v_score", "v_score"))
def q_read_parquet_source(spark, d):
    """S-7 / S-8: ``parquet:<path>`` source."""
    path = scratch_path(spark, "scores-parquet")
    B.scores(spark, d).write.mode("overwrite").parquet(path)
    return FS.load_source(spark, f"parquet:{path}")


@query("union_quarters", with_views("""
SELECT loan_id, reporting_month, CASE WHEN year(reporting_month) % 2 = 1 THEN modification_flag END AS modification_flag,
       current_actual_upb FROM v_perf""", "v_perf", dates=["reporting_month"]))
def q_union_quarters(spark, d):
    """S-12 / U-1: quarter files with different columns unioned by name (missing → NULL)."""
    p = B.perf(spark, d).select("loan_id", "reporting_month", "modification_flag", "current_actual_upb")
    even, odd = scratch_path(spark, "perf-even"), scratch_path(spark, "perf-odd")
    p.where(F.year("reporting_month") % 2 == 0).drop("modification_flag").write.mode("overwrite").parquet(even)
    p.where(F.year("reporting_month") % 2 == 1).write.mode("overwrite").parquet(odd)
    u = FS.union_quarters(spark, [even, odd])
    return u.select("loan_id", "reporting_month", "modification_flag", "current_actual_upb")


def _landed_series_json(spark, d) -> str:
    s = B.series_daily(spark, d)
    val = F.when(F.dayofmonth("date") == 15, F.lit(".")).otherwise(F.col("value").cast("string"))
    docs = (s.groupBy("series_id", F.trunc("date", "MM").alias("m"))
            .agg(F.collect_list(F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"),
                                         val.alias("value"))).alias("observations")))
    path = scratch_path(spark, "series-json")
    docs.select("series_id", "observations").write.mode("overwrite").json(path)
    return path


@query("read_series_json", with_views(
    "SELECT series_id, date, CASE WHEN day(date) = 15 THEN NULL ELSE round(value, 6) END AS value "
    "FROM v_series_daily", "v_series_daily", dates=["date"]))
def q_read_series_json(spark, d):
    """S-9: observation documents (one per series-month) → (series, date, value); '.' → NULL."""
    obs = SR.read_series_json(spark, _landed_series_json(spark, d))
    return obs.select("series_id", "date", F.round("value", 6).alias("value"))


@query("read_series_csv", with_views(
    "SELECT series_id, date, round(value, 6) AS value FROM v_series_daily", "v_series_daily", dates=["date"]))
def q_read_series_csv(spark, d):
    """S-10: header CSV files ``DATE,VALUE`` per series folder → (series, date, value)."""
    s = B.series_daily(spark, d)
    path = scratch_path(spark, "series-csv")
    (s.select(F.date_format("date", "yyyy-MM-dd").alias("DATE"), F.col("value").cast("string").alias(" VALUE "),
              "series_id").write.mode("overwrite").option("header", "true").partitionBy("series_id").csv(path))
    obs = SR.read_series_csv(spark, path)
    return obs.select("series_id", "date", F.round("value", 6).alias("value"))


_WIDE = {
    "cal": """SELECT series_id, CAST(unnest(generate_series(CAST(min(date_trunc('month', date)) AS TIMESTAMP),
                 CAST(max(date_trunc('month', date)) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
              FROM v_series_daily GROUP BY series_id""",
    "mm": """SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS month, avg(value) AS value
             FROM v_series_daily GROUP BY 1, 2""",
    "monthly": "SELECT cal.series_id, cal.month, mm.value FROM cal LEFT JOIN mm USING (series_id, month)",
}
_SERIES = sorted(["urgent", "high", "medium", "not_specified", "low"])


@query("write_macro_monthly", with_views(
    "SELECT strftime(month, '%Y-%m') AS period, " + ", ".join(
        f"round(max(value) FILTER (WHERE series_id = '{s}'), 6) AS {s}" for s in _SERIES)
    + " FROM monthly GROUP BY 1", "v_series_daily", extra=_WIDE))
def q_write_macro_monthly(spark, d):
    """S-11: per-series resample + pivot → Parquet; a second call reuses the written copy."""
    path = scratch_path(spark, "macro-monthly")
    methods = {s: "mean" for s in _SERIES}
    SR.write_macro_monthly(spark, B.series_daily(spark, d), methods, path, overwrite=True)
    w = SR.write_macro_monthly(spark, B.series_daily(spark, d), methods, path)
    return w.select("period", *[F.round(s, 6).alias(s) for s in _SERIES])


@query("write_features", with_views(f"""
SELECT f.*, s.max_loan_age, s.latest_upb, s.max_dpd
FROM ({_ORIG_FEATURES_SQL}) f JOIN v_orig o ON f.loan_id = o.loan_id
LEFT JOIN ({_SUMMARY_SQL}) s ON o.loan_sequence_number = s.loan_sequence_number
""", "v_orig", "v_perf"))
def q_write_features(spark, d):
    """S-13: the feature table written to Parquet and read back."""
    path = scratch_path(spark, "features")
    FS.write_parquet(q_feature_table(spark, d), path)
    return FS.read_parquet(spark, path)


@query("label_dataset", with_views(_LABEL_SQL, "v_panel", dates=["reporting_month"]))
def q_label_dataset(spark, d):
    """S-14: a CSV panel → labels → Parquet."""
    src = scratch_path(spark, "panel") + ".csv"
    B.panel(spark, d).write.mode("overwrite").option("header", "true").csv(src)
    out = FS.label_dataset(spark, src, scratch_path(spark, "labeled"))
    return out.select(F.col("loan_id").cast("bigint"), "reporting_month", F.col("dpd").cast("int"), "label")


@query("file_lineage")
def q_file_lineage(spark, d):
    """S-15 (rows only): path, size and SHA-256 of every driver table file."""
    return FS.file_lineage(spark, d, "*.parquet")


@query("file_lineage_tree")
def q_file_lineage_tree(spark, d):
    """S-15 (rows only): the same files hashed block by block, with the root of their digests."""
    return FS.file_lineage_tree(spark, d, "*.parquet", block_bytes=1 << 20)


@query("report_json_sink", with_views("""
SELECT feature, round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic, round(ks_p_value, 6) AS ks_p_value
FROM core""", "v_ref", "v_cur", extra=__import__(
    "tallyrisk.plans.q_drift", fromlist=["_drift_ctes"])._drift_ctes("v_ref", "v_cur", B.DRIFT_FEATURES)))
def q_report_json_sink(spark, d):
    """S-16: the feature drift report written as JSON and read back."""
    ref, cur = B.drift_frames(spark, d)
    fd = D.feature_drift(ref, cur, B.DRIFT_FEATURES).select("feature", "psi", "ks_statistic", "ks_p_value")
    return FS.write_json_report(fd, scratch_path(spark, "drift-json"))


@query("summary_markdown")
def q_summary_markdown(spark, d):
    """S-17 (rows only): the monitoring report, score drift included, as one Markdown document."""
    from .q_drift import _score_frames

    ref, cur = B.drift_frames(spark, d)
    fd = D.feature_drift(ref, cur, B.DRIFT_FEATURES)
    s = B.scores(spark, d)
    # One row and a row per period: found once, read by the report and by the tables under it.
    score = D.score_drift(*_score_frames(spark, d), "pd").checkpoint(eager=True)
    rolling = PD.rolling_auc(s).checkpoint(eager=True)
    return FS.summary_markdown(PD.monitoring_report(fd, score, PD.perf_drift(s, rolling=rolling)), score=score,
                               rolling=rolling, policy_version="balanced-1")



_PERF_RT = ["loan_sequence_number", "monthly_reporting_period", "current_actual_upb", "loan_age",
            "current_interest_rate", "modification_flag"]


@query("perf_tape_round_trip", with_views("""
SELECT loan_sequence_number, monthly_reporting_period, current_actual_upb, loan_age, current_interest_rate,
       modification_flag, CAST(year(reporting_month) AS VARCHAR) || 'Q' || CAST(quarter(reporting_month) AS VARCHAR)
       AS quarter FROM v_perf""", "v_perf"))
def q_perf_tape_round_trip(spark, d):
    """S-3: the performance tape landed per quarter, ingested to typed Parquet, read back."""
    p = B.perf_tape(spark, d)
    p = p.withColumn("quarter", F.concat(F.substring("monthly_reporting_period", 3, 4), F.lit("Q"),
                                         F.ceil(F.substring("monthly_reporting_period", 1, 2).cast("int") / 3)
                                         .cast("string")))
    src = scratch_path(spark, "perf-tape")
    TP.write_tape(p, TP.PERFORMANCE_COLUMNS, src, partition_col="quarter")
    out = TP.ingest_tape(spark, src, "performance", scratch_path(spark, "perf-parquet"))
    return out.select(*_PERF_RT, "quarter")


@query("read_delimited_tape", with_views(
    "SELECT " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in _TAPE_STR) + " FROM v_orig_tape", "v_orig_tape"))
def q_read_delimited_tape(spark, d):
    """S-1: the landed origination tape read back by position, every field a string."""
    raw = TP.read_delimited_tape(spark, _landed_orig_tape(spark, d), TP.ORIGINATION_COLUMNS)
    return raw.select(*_TAPE_STR)
