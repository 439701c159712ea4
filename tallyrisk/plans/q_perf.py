"""Queries: rolling window members, rolling AUC, trend, performance drift, high-drift
features and the consolidated monitoring report (N-1, N-10, N-11, M-8, M-9, M-11, W-8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as D
from ..operators import perf_drift as PD
from . import bindings as B
from .catalog import query
from .oracle_views import with_views
from .q_drift import FEATS, _drift_ctes, _SEV, _SSEV, _SREF, _SCUR

_ROLL = {
    "per": "SELECT DISTINCT period FROM v_score WHERE period IS NOT NULL",
    "idx": "SELECT period, row_number() OVER (ORDER BY period) - 1 AS i FROM per",
    "mem": "SELECT a.period AS anchor, p.period AS member FROM idx a JOIN idx p ON p.i BETWEEN a.i - 2 AND a.i",
    "rc": """SELECT m.anchor, s.pd AS s, sum(s.label) AS pos, sum(1 - s.label) AS neg
             FROM v_score s JOIN mem m ON s.period = m.member GROUP BY m.anchor, s.pd""",
    "rw": """SELECT anchor, pos, neg,
               sum(neg) OVER (PARTITION BY anchor ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fps,
               sum(pos) OVER (PARTITION BY anchor) AS P, sum(neg) OVER (PARTITION BY anchor) AS N FROM rc""",
    "roll": """SELECT anchor AS period,
                 round(CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(pos * (N - fps + neg / 2.0)) / (max(P) * max(N)) END, 6) AS auc,
                 CAST(max(P) + max(N) AS BIGINT) AS n_obs, CAST(max(P) AS BIGINT) AS n_defaults
               FROM rw GROUP BY anchor""",
    "valid": "SELECT period, auc, row_number() OVER (ORDER BY period) - 1 AS x FROM roll WHERE auc IS NOT NULL",
    "pdr": """SELECT round(arg_max(auc, period), 6) AS latest_auc,
                CASE WHEN count(*) >= 2 THEN round(regr_slope(auc, x), 6) END AS slope,
                CASE WHEN count(*) < 2 THEN 'insufficient_data' WHEN regr_slope(auc, x) > 0 THEN 'improving'
                     ELSE 'degrading' END AS trend,
                CAST(0.65 AS DOUBLE) AS auc_alert_threshold, coalesce(arg_max(auc, period) < 0.65, false) AS alert FROM valid""",
}


def _scores(spark, d):
    return B.scores(spark, d)


@query("rolling_window_members", with_views("SELECT anchor, member FROM mem", "v_score", extra=_ROLL))
def q_rolling_window_members(spark, d):
    return PD.rolling_window_members(_scores(spark, d))


@query("rolling_auc", with_views("SELECT * FROM roll", "v_score", extra=_ROLL))
def q_rolling_auc(spark, d):
    return PD.rolling_auc(_scores(spark, d))


@query("latest_valid", with_views("SELECT round(arg_max(auc, period), 6) AS latest_auc FROM valid",
                                  "v_score", extra=_ROLL))
def q_latest_valid(spark, d):
    return PD.latest_valid(PD.rolling_auc(_scores(spark, d))).select(
        F.round("latest_auc", 6).alias("latest_auc"))


@query("trend_slope", with_views("SELECT slope, trend FROM pdr", "v_score", extra=_ROLL))
def q_trend_slope(spark, d):
    return PD.trend_slope(PD.rolling_auc(_scores(spark, d)))


@query("perf_drift", with_views("SELECT * FROM pdr", "v_score", extra=_ROLL))
def q_perf_drift(spark, d):
    return PD.perf_drift(_scores(spark, d))


@query("high_drift_features", with_views(f"""
SELECT feature, round(psi, 6) AS psi, {_SEV} AS severity FROM core WHERE round(psi, 6) > 0.25
""", "v_ref", "v_cur", extra=_drift_ctes("v_ref", "v_cur", FEATS)))
def q_high_drift_features(spark, d):
    ref, cur = B.drift_frames(spark, d)
    fd = D.feature_drift(ref, cur, FEATS)
    return PD.high_drift_features(fd).select("feature", "psi", "severity")


_FD = f"""SELECT 'feature_drift' AS "check", feature AS name, {_SEV} AS severity,
            round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic, round(ks_p_value, 6) AS ks_p_value FROM core"""


@query("monitoring_job", with_views(f"""
SELECT "check", name, metric, CAST(value AS DOUBLE) AS value, severity FROM (
  SELECT "check", name, metric, value, severity FROM (UNPIVOT ({_FD}) ON psi, ks_statistic, ks_p_value INTO NAME metric VALUE value)
  UNION ALL
  SELECT 'score_drift', 'score', metric, value, severity FROM (UNPIVOT (
    SELECT round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic, round(ks_p_value, 6) AS ks_p_value,
           round(cm - rm, 6) AS mean_shift, {_SSEV} AS severity
    FROM score_core, (SELECT avg(pd) AS rm FROM sref) a, (SELECT avg(pd) AS cm FROM scur) b)
    ON psi, ks_statistic, ks_p_value, mean_shift INTO NAME metric VALUE value)
  UNION ALL
  SELECT 'perf_drift', 'auc', metric, value, CASE WHEN alert THEN 'alert' ELSE 'ok' END FROM (UNPIVOT (
    SELECT latest_auc, slope, alert FROM pdr) ON latest_auc, slope INTO NAME metric VALUE value)
) u""", "v_ref", "v_cur", "v_score", extra={
    **_drift_ctes("v_ref", "v_cur", FEATS), **_ROLL, "sref": _SREF, "scur": _SCUR,
    **_drift_ctes("sref", "scur", ["pd"], p="score_"),
}))
def q_monitoring_job(spark, d):
    ref, cur = B.drift_frames(spark, d)
    fd = D.feature_drift(ref, cur, FEATS)
    s = _scores(spark, d)
    sr, sc = s.where(F.col("period") < "1998-07"), s.where(F.col("period") >= "1998-07")
    sd = D.score_drift(sr, sc, "pd")
    return PD.monitoring_report(fd, sd, PD.perf_drift(s))
