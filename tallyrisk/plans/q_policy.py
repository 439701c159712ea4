"""Queries: decisions, review capacity, policy metrics and comparison, portfolio views
(P-12..P-14, N-2, N-7, A-3..A-7) over ``v_score``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import policy as P
from . import bindings as B
from .catalog import query
from .oracle_views import with_views

_POL = ("SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{p.name}', CAST({p.approve} AS DOUBLE), CAST({p.decline} AS DOUBLE), CAST({p.capacity} AS DOUBLE))"
    for i, p in enumerate(P.DEFAULT_POLICIES)) + ") t(policy_order, policy, approve, decline, capacity)")

_DECIDED = {
    "pol": _POL,
    "raw": """SELECT p.policy, p.policy_order, s.id, s.pd, s.label, p.capacity,
                CASE WHEN s.pd < p.approve THEN 'approve' WHEN s.pd >= p.decline THEN 'decline' ELSE 'review' END AS raw
              FROM v_score s CROSS JOIN pol p""",
    "tot": """SELECT policy, count(*) FILTER (WHERE raw = 'review') AS nr,
                greatest(1, floor(count(*) * max(capacity))) AS mr FROM raw GROUP BY policy""",
    "rk": """SELECT policy, id, row_number() OVER (PARTITION BY policy ORDER BY pd DESC, id ASC) AS rn
             FROM raw WHERE raw = 'review'""",
    "decided": """SELECT r.policy, r.policy_order, r.id, r.pd, r.label,
                    CASE WHEN r.raw = 'review' AND t.nr > t.mr AND rk.rn > t.mr THEN 'approve' ELSE r.raw END AS decision
                  FROM raw r JOIN tot t USING (policy) LEFT JOIN rk ON rk.policy = r.policy AND rk.id = r.id""",
}

_METRICS = """SELECT policy, min(policy_order) AS policy_order, CAST(count(*) AS BIGINT) AS n_total,
  CAST(count(*) FILTER (WHERE decision = 'approve') AS BIGINT) AS n_approved,
  CAST(count(*) FILTER (WHERE decision = 'review') AS BIGINT) AS n_review,
  CAST(count(*) FILTER (WHERE decision = 'decline') AS BIGINT) AS n_declined,
  round(count(*) FILTER (WHERE decision = 'approve') / count(*), 6) AS approval_rate,
  round(count(*) FILTER (WHERE decision = 'review') / count(*), 6) AS review_rate,
  round(count(*) FILTER (WHERE decision = 'decline') / count(*), 6) AS decline_rate,
  round(coalesce(avg(pd) FILTER (WHERE decision = 'approve'), 0.0), 6) AS mean_pd_approved,
  round(coalesce(sum(pd) FILTER (WHERE decision = 'approve') * 0.6 / count(*), 0.0), 6) AS expected_loss_rate,
  round(avg(CAST(label AS DOUBLE)) FILTER (WHERE decision = 'approve'), 6) AS actual_default_rate_approved
FROM decided GROUP BY policy"""


@query("policy_decide", with_views("""
SELECT id, pd, CASE WHEN pd < 0.10 THEN 'approve' WHEN pd >= 0.25 THEN 'decline' ELSE 'review' END AS decision
FROM v_score""", "v_score"))
def q_policy_decide(spark, d):
    s = B.scores(spark, d)
    return s.select("id", "pd", P.decide(F.col("pd"), 0.10, 0.25).alias("decision"))


@query("review_capacity", with_views(
    "SELECT policy, id, pd, decision FROM decided", "v_score", extra=_DECIDED))
def q_review_capacity(spark, d):
    return P.decide_with_capacity(B.scores(spark, d), P.DEFAULT_POLICIES).select(
        "policy", "id", "pd", "decision")


@query("policy_metrics", with_views(
    "SELECT * EXCLUDE (policy_order) FROM m WHERE policy = 'balanced'", "v_score",
    extra={**_DECIDED, "m": _METRICS}))
def q_policy_metrics(spark, d):
    s = B.scores(spark, d)
    dec = P.decide_with_capacity(s, [P.DEFAULT_POLICIES[1]], extra_cols=["label"])
    return P.policy_metrics(dec).drop("policy_order")


@query("policy_metrics_all", with_views(
    "SELECT * EXCLUDE (policy_order) FROM m", "v_score", extra={**_DECIDED, "m": _METRICS}))
def q_policy_metrics_all(spark, d):
    """A-3 for every policy; ``policy_metrics`` is the row of 'balanced'."""
    return P.policy_metrics_of_scores(B.scores(spark, d), P.DEFAULT_POLICIES).drop("policy_order")


@query("compare_policies", with_views(
    "SELECT m.*, ds.* FROM m, (SELECT CAST(count(*) AS BIGINT) AS dataset_n, round(avg(pd), 6) AS dataset_mean_pd "
    "FROM v_score) ds", "v_score", extra={**_DECIDED, "m": _METRICS}))
def q_compare_policies(spark, d):
    return P.compare_policies(B.scores(spark, d))


@query("best_policy", with_views("""
SELECT arg_max(policy, (approval_rate, -policy_order)) AS best_approval_policy,
       max(approval_rate) AS best_approval_rate,
       arg_min(policy, (expected_loss_rate, policy_order)) AS best_loss_policy,
       min(expected_loss_rate) AS best_expected_loss_rate
FROM m""", "v_score", extra={**_DECIDED, "m": _METRICS}))
def q_best_policy(spark, d):
    return P.best_policy(P.compare_policies(B.scores(spark, d)))


@query("portfolio_summary", with_views("""
SELECT CAST(count(*) AS BIGINT) AS n_loans, round(avg(pd), 6) AS mean_pd,
       CAST(count(*) FILTER (WHERE pd >= 0.5) AS BIGINT) AS n_high_risk FROM v_score""", "v_score"))
def q_portfolio_summary(spark, d):
    return P.portfolio_summary(B.scores(spark, d))


_TIER = "CASE WHEN pd < 0.25 THEN 'Low' WHEN pd < 0.5 THEN 'Moderate' WHEN pd < 0.75 THEN 'High' ELSE 'Very High' END"


@query("risk_tier", with_views(f"SELECT id, pd, {_TIER} AS tier FROM v_score", "v_score"))
def q_risk_tier(spark, d):
    s = B.scores(spark, d)
    return s.select("id", "pd", P.risk_tier(F.col("pd")).alias("tier"))


@query("score_decision", with_views(
    "SELECT id, pd, CASE WHEN pd >= 0.5 THEN 'default' ELSE 'current' END AS decision FROM v_score",
    "v_score"))
def q_score_decision(spark, d):
    s = B.scores(spark, d)
    return s.select("id", "pd", P.score_decision(F.col("pd")).alias("decision"))


@query("tier_counts", with_views(f"""
WITH dim AS (SELECT * FROM (VALUES (0, 'Low'), (1, 'Moderate'), (2, 'High'), (3, 'Very High')) t(tier_order, tier)),
c AS (SELECT {_TIER} AS tier, count(*) AS n FROM v_score GROUP BY 1)
SELECT dim.tier, dim.tier_order, CAST(coalesce(c.n, 0) AS BIGINT) AS n,
       round(coalesce(c.n, 0) / (SELECT sum(n) FROM c), 6) AS share
FROM dim LEFT JOIN c USING (tier)""", "v_score"))
def q_tier_counts(spark, d):
    return P.tier_counts(B.scores(spark, d))


@query("portfolio_sort", with_views(f"SELECT id, pd, label, period, {_TIER} AS tier FROM v_score", "v_score"))
def q_portfolio_sort(spark, d):
    return P.portfolio_sort(B.scores(spark, d))
