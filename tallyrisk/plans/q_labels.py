"""Queries: forward default label and its summaries (J-1, J-7, W-1, U-3, A-11, P-11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels as L
from . import bindings as B
from .catalog import query
from .oracle_views import with_views

_LABEL_SQL = """
SELECT p.loan_id, p.reporting_month, p.dpd,
  CASE WHEN EXISTS (SELECT 1 FROM v_panel b
                    WHERE b.loan_id = p.loan_id AND b.dpd >= 60
                      AND b.reporting_month > p.reporting_month
                      AND b.reporting_month <= p.reporting_month + INTERVAL 12 MONTH)
       THEN 1 ELSE 0 END AS label
FROM v_panel p
"""


def labeled_panel(spark, d):
    return L.forward_default_label(B.panel(spark, d))


@query("forward_default_label", with_views(_LABEL_SQL, "v_panel", dates=["reporting_month"]))
def q_forward_default_label(spark, d):
    return labeled_panel(spark, d)


@query("default_rate_by_month", with_views(f"""
SELECT strftime(reporting_month, '%Y-%m-%d') AS month, CAST(count(*) AS BIGINT) AS n_obs,
       CAST(sum(label) AS BIGINT) AS n_default, round(avg(label), 6) AS default_rate
FROM ({_LABEL_SQL}) t GROUP BY reporting_month
""", "v_panel"))
def q_default_rate_by_month(spark, d):
    return L.default_rate_by_month(labeled_panel(spark, d))


@query("label_balance", with_views(f"""
SELECT CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) AS BIGINT) AS total,
       round(sum(label) * 100.0 / count(*), 6) AS percent
FROM ({_LABEL_SQL}) t
""", "v_panel"))
def q_label_balance(spark, d):
    return L.label_balance(labeled_panel(spark, d))


@query("label_horizon6_threshold30", with_views("""
SELECT p.loan_id, p.reporting_month, p.dpd,
  CASE WHEN EXISTS (SELECT 1 FROM v_panel b
                    WHERE b.loan_id = p.loan_id AND b.dpd >= 30
                      AND b.reporting_month > p.reporting_month
                      AND b.reporting_month <= p.reporting_month + INTERVAL 6 MONTH)
       THEN 1 ELSE 0 END AS label
FROM v_panel p
""", "v_panel", dates=["reporting_month"]))
def q_label_custom(spark, d):
    return L.forward_default_label(B.panel(spark, d), horizon=6, threshold=30)


@query("bad_event_filter", with_views(
    "SELECT loan_id, reporting_month, dpd FROM v_panel WHERE dpd >= 60", "v_panel",
    dates=["reporting_month"]))
def q_bad_event_filter(spark, d):
    return L.bad_events(B.panel(spark, d))


@query("label_left_merge", with_views("""
SELECT p.loan_id, p.reporting_month, p.dpd, CASE WHEN f.loan_id IS NULL THEN 0 ELSE 1 END AS label
FROM v_panel p LEFT JOIN (
  SELECT DISTINCT o.loan_id, o.reporting_month FROM v_panel o JOIN v_panel b
    ON o.loan_id = b.loan_id AND b.dpd >= 60 AND b.reporting_month > o.reporting_month
   AND b.reporting_month <= o.reporting_month + INTERVAL 12 MONTH) f
  ON p.loan_id = f.loan_id AND p.reporting_month = f.reporting_month
""", "v_panel", dates=["reporting_month"]))
def q_label_left_merge(spark, d):
    return L.forward_default_label_naive(B.panel(spark, d))


@query("distinct_keys", with_views("""
SELECT DISTINCT o.loan_id, o.reporting_month FROM v_panel o JOIN v_panel b
  ON o.loan_id = b.loan_id AND b.dpd >= 60 AND b.reporting_month > o.reporting_month
 AND b.reporting_month <= o.reporting_month + INTERVAL 12 MONTH
""", "v_panel", dates=["reporting_month"]))
def q_distinct_keys(spark, d):
    lab = labeled_panel(spark, d)
    return lab.where(F.col("label") == 1).select("loan_id", "reporting_month").distinct()


@query("default_label", with_views("""
SELECT loan_id, reporting_month, zero_balance_code,
       CASE WHEN zero_balance_code IN ('02','03','06','09','15') THEN 1 ELSE 0 END AS default_label
FROM v_perf
""", "v_perf", dates=["reporting_month"]))
def q_default_label(spark, d):
    p = B.perf(spark, d)
    return p.select("loan_id", "reporting_month", "zero_balance_code",
                    L.default_label(p).alias("default_label"))
