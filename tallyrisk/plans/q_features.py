"""Queries: cleaning, coercion, periods, features, summary, validation
(P-1..P-7, P-10, P-16, F-1..F-18, A-1, J-2, M-12, M-13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions.features import CLIP_BOUNDS, build_features, missing_required
from ..operators import summary as S
from ..operators.validate import ORIGINATION_RULES, violation_report
from . import bindings as B
from .catalog import query
from .oracle_views import blank, integer, num, parse_period, six_digit_period, with_views

_TAPE_STR = [c for c in B.ORIG_TAPE_COLUMNS]


@query("normalize_blanks", with_views(
    "SELECT loan_id, " + ", ".join(f"{blank(c)} AS {c}" for c in _TAPE_STR) + " FROM v_orig_tape",
    "v_orig_tape"))
def q_normalize_blanks(spark, d):
    return C.normalize_blanks(B.orig_tape(spark, d).select("loan_id", *_TAPE_STR))


_NUMS = ["credit_score", "mi_pct", "orig_cltv", "orig_dti", "orig_upb", "orig_ltv",
         "orig_interest_rate", "num_units", "orig_loan_term", "num_borrowers"]


@query("coerce_types", with_views(
    "SELECT loan_id, " + ", ".join(
        f"{integer(c) if B.ORIG_TYPES[c] == 'long' else num(c)} AS {c}" for c in _NUMS)
    + " FROM v_orig_tape", "v_orig_tape"))
def q_coerce_types(spark, d):
    t = B.orig_tape(spark, d).select("loan_id", *_NUMS)
    return C.coerce_types(C.normalize_blanks(t), B.ORIG_TYPES)


_PRESENT = ["credit_score", "orig_ltv", "orig_dti", "orig_upb", "orig_interest_rate",
            "orig_loan_term", "num_units", "num_borrowers", "msa", "loan_id", "occupancy_status",
            "loan_purpose", "channel", "property_type", "postal_code", "first_time_homebuyer_flag"]


@query("select_present", with_views(
    "SELECT credit_score, orig_ltv, orig_dti, orig_upb, orig_interest_rate, orig_loan_term, "
    "num_units, num_borrowers, loan_id, occupancy_status, loan_purpose, channel, property_type, "
    "first_time_homebuyer_flag FROM v_orig", "v_orig"))
def q_select_present(spark, d):
    o = B.orig(spark, d)
    return o.select([c for c in _PRESENT if c in o.columns])


def _clip_sql(c: str, lo: float, hi: float) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {lo}), {hi}) END"


_CLIPPED = ["credit_score", "orig_ltv", "orig_cltv", "orig_dti", "orig_interest_rate"]


@query("clip_bounds", with_views(
    "SELECT loan_id, " + ", ".join(f"{_clip_sql(c, *CLIP_BOUNDS[c])} AS {c}" for c in _CLIPPED)
    + " FROM v_orig", "v_orig"))
def q_clip_bounds(spark, d):
    o = B.orig(spark, d)
    return o.select("loan_id", *[C.clip(F.col(c), *CLIP_BOUNDS[c]).alias(c) for c in _CLIPPED])


@query("parse_period", with_views(
    "SELECT loan_id, first_payment_date, first_payment_month AS period_month, "
    "strftime(first_payment_month, '%Y-%m') AS period FROM v_orig", "v_orig",
    dates=["period_month"]))
def q_parse_period(spark, d):
    o = B.orig(spark, d)
    return o.select("loan_id", "first_payment_date", F.col("first_payment_month").alias("period_month"),
                    C.period_text(F.col("first_payment_month")).alias("period"))


_TP = "lpad(CAST(TRY_CAST(TRY_CAST(monthly_reporting_period AS DOUBLE) AS BIGINT) AS VARCHAR), 6, '0')"


@query("parse_tape_period", with_views(
    f"SELECT loan_id, monthly_reporting_period, {six_digit_period(_TP)} AS period "
    "FROM v_perf_tape WHERE " + six_digit_period(_TP) + " IS NOT NULL", "v_perf_tape",
    dates=["period"]))
def q_parse_tape_period(spark, d):
    """P-7 with W-3: rows whose period does not parse are dropped."""
    t = B.perf_tape(spark, d)
    p = C.parse_tape_period(F.col("monthly_reporting_period"))
    return t.select("loan_id", "monthly_reporting_period", p.alias("period")).where(
        F.col("period").isNotNull())


@query("month_arith", with_views(
    "SELECT loan_id, monthly_reporting_period, "
    "strftime(strptime(monthly_reporting_period, '%m%Y') + INTERVAL 3 MONTH, '%Y%m') AS plus3_yyyymm "
    "FROM v_perf_tape", "v_perf_tape"))
def q_month_arith(spark, d):
    t = B.perf_tape(spark, d)
    return t.select("loan_id", "monthly_reporting_period",
                    C.add_months_text(F.col("monthly_reporting_period"), 3).alias("plus3_yyyymm"))


@query("dedup_keep_first", with_views("""
SELECT loan_id, reporting_month, current_actual_upb FROM (
  SELECT loan_id, reporting_month, current_actual_upb,
         row_number() OVER (PARTITION BY loan_id ORDER BY reporting_month, current_actual_upb) AS rn
  FROM v_perf) t WHERE rn = 1
""", "v_perf", dates=["reporting_month"]))
def q_dedup_keep_first(spark, d):
    """P-6: first row per loan by (period, upb); an aggregate (``min_by``), so a hot
    loan is combined map-side instead of sorted in one task."""
    p = B.perf(spark, d)
    first = p.groupBy("loan_id").agg(F.min_by(
        F.struct("reporting_month", "current_actual_upb"),
        F.struct("reporting_month", "current_actual_upb")).alias("r"))
    return first.select("loan_id", "r.reporting_month", "r.current_actual_upb")


_SUMMARY_SQL = """
SELECT loan_sequence_number, max(CAST(loan_age AS DOUBLE)) AS max_loan_age,
       arg_max(current_actual_upb, (reporting_month, current_actual_upb))
         FILTER (WHERE current_actual_upb IS NOT NULL) AS latest_upb,
       max(TRY_CAST(current_delinquency_status AS DOUBLE)) AS max_dpd
FROM v_perf GROUP BY loan_sequence_number
"""


@query("perf_summary", with_views(_SUMMARY_SQL, "v_perf"))
def q_perf_summary(spark, d):
    return S.perf_summary(B.perf(spark, d))


@query("loan_summary_join", with_views(f"""
SELECT o.loan_id, o.loan_sequence_number, o.orig_upb, s.max_loan_age, s.latest_upb, s.max_dpd
FROM v_orig o LEFT JOIN ({_SUMMARY_SQL}) s ON o.loan_sequence_number = s.loan_sequence_number
""", "v_orig", "v_perf"))
def q_loan_summary_join(spark, d):
    o = B.orig(spark, d).select("loan_id", "loan_sequence_number", "orig_upb")
    return S.loan_summary_join(o, B.perf(spark, d))


def _flag(cond: str) -> str:
    return f"coalesce(CAST(({cond}) AS DOUBLE), 0.0)"


def _code(c: str, m: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in m.items())
    return f"CAST(CASE upper(trim({c})) {whens} END AS TINYINT)"


_ORIG_FEATURES_SQL = f"""
SELECT loan_id,
  {_clip_sql('credit_score', 300.0, 850.0)} AS credit_score,
  {_clip_sql('orig_ltv', 0.0, 105.0)} AS orig_ltv,
  {_clip_sql('orig_dti', 0.0, 65.0)} AS orig_dti,
  orig_upb,
  {_clip_sql('orig_interest_rate', 0.5, 20.0)} AS orig_interest_rate,
  orig_loan_term, num_units, num_borrowers,
  CASE WHEN orig_upb IS NULL THEN NULL ELSE least(greatest(ln(greatest(orig_upb, 1.0)), 9.0), 14.0) END AS log_upb,
  CAST(CASE upper(trim(first_time_homebuyer_flag)) WHEN 'Y' THEN 1.0 WHEN 'N' THEN 0.0 END AS DOUBLE) AS is_first_time_homebuyer,
  {_flag('orig_ltv > 80')} AS is_high_ltv,
  {_flag('orig_dti > 43')} AS is_high_dti,
  {_flag("upper(trim(amortization_type)) = 'ARM'")} AS is_arm,
  {_flag('orig_upb > 766550')} AS is_jumbo,
  {_code('occupancy_status', {'P': 0, 'I': 1, 'S': 2})} AS occupancy_code,
  {_code('loan_purpose', {'P': 0, 'C': 1, 'N': 2, 'R': 3})} AS loan_purpose_code,
  {_code('channel', {'R': 0, 'B': 1, 'C': 2, 'T': 3})} AS channel_code,
  {_code('property_type', {'SF': 0, 'CO': 1, 'PU': 2, 'MH': 3, 'CP': 4})} AS property_type_code
FROM v_orig
"""

_ORIG_KEEP = ["loan_id", "credit_score", "orig_ltv", "orig_dti", "orig_upb", "orig_interest_rate",
              "orig_loan_term", "num_units", "num_borrowers"]


def origination_feature_frame(spark, d):
    return build_features(B.orig(spark, d), ["origination"], keep=_ORIG_KEEP)


@query("origination_features", with_views(_ORIG_FEATURES_SQL, "v_orig"))
def q_origination_features(spark, d):
    return origination_feature_frame(spark, d)


@query("feature_table", with_views(f"""
SELECT f.*, s.max_loan_age, s.latest_upb, s.max_dpd
FROM ({_ORIG_FEATURES_SQL}) f JOIN v_orig o ON f.loan_id = o.loan_id
LEFT JOIN ({_SUMMARY_SQL}) s ON o.loan_sequence_number = s.loan_sequence_number
""", "v_orig", "v_perf"))
def q_feature_table(spark, d):
    """S-13's content: origination features + per-loan performance summary (J-2)."""
    o = B.orig(spark, d)
    summ = S.perf_summary(B.perf(spark, d))
    j = o.join(summ, "loan_sequence_number", "left")
    return build_features(j, ["origination"],
                          keep=_ORIG_KEEP + ["max_loan_age", "latest_upb", "max_dpd"])


@query("performance_features", with_views("""
SELECT p.loan_id, p.reporting_month,
  coalesce(CAST(TRY_CAST(p.current_delinquency_status AS DOUBLE) > 0 AS DOUBLE), 0.0) AS is_delinquent,
  CAST(CASE WHEN TRY_CAST(p.current_delinquency_status AS DOUBLE) <= -1 THEN NULL
       WHEN TRY_CAST(p.current_delinquency_status AS DOUBLE) <= 0 THEN 0.0
       WHEN TRY_CAST(p.current_delinquency_status AS DOUBLE) <= 1 THEN 1.0
       WHEN TRY_CAST(p.current_delinquency_status AS DOUBLE) <= 2 THEN 2.0
       WHEN TRY_CAST(p.current_delinquency_status AS DOUBLE) > 2 THEN 3.0 END AS DOUBLE) AS delinquency_bucket,
  CASE WHEN o.orig_upb IS NULL OR p.current_actual_upb IS NULL THEN NULL
       ELSE least(greatest((o.orig_upb - p.current_actual_upb) / greatest(o.orig_upb, 1.0), 0.0), 1.0) END
    AS paydown_ratio,
  p.current_interest_rate - o.orig_interest_rate AS rate_spread,
  CASE WHEN o.orig_loan_term IS NULL OR p.remaining_months_to_legal_maturity IS NULL THEN NULL
       ELSE least(greatest(p.remaining_months_to_legal_maturity / greatest(CAST(o.orig_loan_term AS DOUBLE), 1.0), 0.0), 1.0) END
    AS term_remaining_ratio,
  coalesce(CAST(upper(trim(p.modification_flag)) = 'Y' AS DOUBLE), 0.0) AS has_been_modified,
  CAST(p.zero_balance_code IS NOT NULL AS DOUBLE) AS zero_balance_flag,
  CASE WHEN p.loan_age IS NULL THEN NULL ELSE power(least(greatest(CAST(p.loan_age AS DOUBLE), 0.0), 480.0), 2) END
    AS loan_age_sq
FROM v_perf p LEFT JOIN v_orig o ON p.loan_id = o.loan_id
""", "v_perf", "v_orig", dates=["reporting_month"]))
def q_performance_features(spark, d):
    return S.performance_features(B.perf(spark, d), B.orig(spark, d))


_CHECKS_SQL = """
  SELECT loan_id, UNNEST([
    CASE WHEN credit_score IS NOT NULL AND TRY_CAST(trim(credit_score) AS DOUBLE) IS NULL THEN 'credit_score:type' END,
    CASE WHEN TRY_CAST(trim(credit_score) AS DOUBLE) NOT BETWEEN 300 AND 850 THEN 'credit_score:range' END,
    CASE WHEN first_payment_date IS NULL THEN 'first_payment_date:not_null' END,
    CASE WHEN first_time_homebuyer_flag NOT IN ('Y','N','9') THEN 'first_time_homebuyer_flag:in_set' END,
    CASE WHEN maturity_date IS NULL THEN 'maturity_date:not_null' END,
    CASE WHEN mi_pct IS NOT NULL AND TRY_CAST(trim(mi_pct) AS DOUBLE) IS NULL THEN 'mi_pct:type' END,
    CASE WHEN TRY_CAST(trim(mi_pct) AS DOUBLE) NOT BETWEEN 0 AND 55 THEN 'mi_pct:range' END,
    CASE WHEN num_units IS NOT NULL AND TRY_CAST(trim(num_units) AS DOUBLE) IS NULL THEN 'num_units:type' END,
    CASE WHEN num_units IS NULL THEN 'num_units:not_null' END,
    CASE WHEN TRY_CAST(trim(num_units) AS DOUBLE) NOT BETWEEN 1 AND 4 THEN 'num_units:range' END,
    CASE WHEN occupancy_status NOT IN ('P','I','S','9') THEN 'occupancy_status:in_set' END,
    CASE WHEN orig_cltv IS NOT NULL AND TRY_CAST(trim(orig_cltv) AS DOUBLE) IS NULL THEN 'orig_cltv:type' END,
    CASE WHEN TRY_CAST(trim(orig_cltv) AS DOUBLE) NOT BETWEEN 0 AND 200 THEN 'orig_cltv:range' END,
    CASE WHEN orig_dti IS NOT NULL AND TRY_CAST(trim(orig_dti) AS DOUBLE) IS NULL THEN 'orig_dti:type' END,
    CASE WHEN TRY_CAST(trim(orig_dti) AS DOUBLE) NOT BETWEEN 0 AND 65 THEN 'orig_dti:range' END,
    CASE WHEN orig_upb IS NOT NULL AND TRY_CAST(trim(orig_upb) AS DOUBLE) IS NULL THEN 'orig_upb:type' END,
    CASE WHEN orig_upb IS NULL THEN 'orig_upb:not_null' END,
    CASE WHEN NOT (TRY_CAST(trim(orig_upb) AS DOUBLE) > 0) THEN 'orig_upb:gt' END,
    CASE WHEN orig_ltv IS NOT NULL AND TRY_CAST(trim(orig_ltv) AS DOUBLE) IS NULL THEN 'orig_ltv:type' END,
    CASE WHEN TRY_CAST(trim(orig_ltv) AS DOUBLE) NOT BETWEEN 0 AND 200 THEN 'orig_ltv:range' END,
    CASE WHEN orig_interest_rate IS NOT NULL AND TRY_CAST(trim(orig_interest_rate) AS DOUBLE) IS NULL THEN 'orig_interest_rate:type' END,
    CASE WHEN orig_interest_rate IS NULL THEN 'orig_interest_rate:not_null' END,
    CASE WHEN TRY_CAST(trim(orig_interest_rate) AS DOUBLE) NOT BETWEEN 0 AND 20 THEN 'orig_interest_rate:range' END,
    CASE WHEN channel NOT IN ('R','B','C','T','9') THEN 'channel:in_set' END,
    CASE WHEN ppm_flag NOT IN ('Y','N') THEN 'ppm_flag:in_set' END,
    CASE WHEN amortization_type NOT IN ('FRM','ARM') THEN 'amortization_type:in_set' END,
    CASE WHEN property_type NOT IN ('SF','PU','CO','MH','CP') THEN 'property_type:in_set' END,
    CASE WHEN loan_sequence_number IS NULL THEN 'loan_sequence_number:not_null' END,
    CASE WHEN loan_purpose NOT IN ('P','C','N','R','9') THEN 'loan_purpose:in_set' END,
    CASE WHEN orig_loan_term IS NOT NULL AND TRY_CAST(trim(orig_loan_term) AS DOUBLE) IS NULL THEN 'orig_loan_term:type' END,
    CASE WHEN orig_loan_term IS NULL THEN 'orig_loan_term:not_null' END,
    CASE WHEN TRY_CAST(trim(orig_loan_term) AS DOUBLE) NOT BETWEEN 1 AND 480 THEN 'orig_loan_term:range' END,
    CASE WHEN super_conforming_flag NOT IN ('Y','N',' ','') THEN 'super_conforming_flag:in_set' END,
    CASE WHEN io_indicator NOT IN ('Y','N') THEN 'io_indicator:in_set' END
  ]) AS rule FROM norm
"""


@query("validate_schema", with_views("""
SELECT rule, CAST(count(*) AS BIGINT) AS n_violations, min(loan_id) AS first_id
FROM checks WHERE rule IS NOT NULL GROUP BY rule
""", "v_orig_tape", extra={"norm": "SELECT loan_id, " + ", ".join(
    f"{blank(c)} AS {c}" for c in _TAPE_STR) + " FROM v_orig_tape", "checks": _CHECKS_SQL}))
def q_validate_schema(spark, d):
    t = C.normalize_blanks(B.orig_tape(spark, d))
    return violation_report(t, ORIGINATION_RULES, "loan_id")


def _required_sql() -> str:
    from ..functions.features import REQUIRED_ORIGINATION_OUTPUTS

    parts = [f"SELECT '{c}' AS \"column\", true AS present, CAST(count({c}) AS BIGINT) AS n_non_null FROM of"
             for c in REQUIRED_ORIGINATION_OUTPUTS]
    return with_views(" UNION ALL ".join(parts), "v_orig", extra={"of": _ORIG_FEATURES_SQL})


@query("required_columns", _required_sql())
def q_required_columns(spark, d):
    """M-13: each required output column: present or not, and its non-null count."""
    return missing_required(origination_feature_frame(spark, d))


_REINDEX = ["credit_score", "orig_ltv", "orig_dti", "orig_upb"]


@query("reindex_features", with_views("""
SELECT loan_id, credit_score, orig_ltv, CAST(NULL AS DOUBLE) AS orig_dti, orig_upb FROM v_orig""", "v_orig"))
def q_reindex_features(spark, d):
    """P-8: records as maps (one key missing, one extra) reindexed to the model's columns."""
    from ..functions.features import reindex_features

    o = B.orig(spark, d)
    rec = F.create_map(F.lit("credit_score"), F.col("credit_score"), F.lit("orig_ltv"), F.col("orig_ltv"),
                       F.lit("orig_upb"), F.col("orig_upb"), F.lit("unused_extra"), F.col("orig_cltv"))
    return o.select("loan_id", *reindex_features(rec, _REINDEX))


@query("panel_sort", with_views("SELECT loan_id, reporting_month, dpd FROM v_panel", "v_panel",
                                dates=["reporting_month"]))
def q_panel_sort(spark, d):
    """N-4: the loan-month panel ordered by (loan, parsed month) — a range-partitioned sort.
    Operators never rely on it: ordering lives inside their windows (T2)."""
    return B.panel(spark, d).orderBy("loan_id", "reporting_month")
