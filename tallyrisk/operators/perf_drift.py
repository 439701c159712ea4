"""Model performance drift: rolling AUC over present periods, trend, alerts, and the
consolidated monitoring report (N-1, N-10, N-11, M-8, M-9, M-11, W-8).

Rolling windows are over the *present* periods sorted as text (not calendar
distance). Rows are first collapsed to (period, score) counts, then fanned out
to the ``window`` anchors each period belongs to, so the data is read once
instead of once per period, and every anchor's AUC is one group of the same
distributed prefix-sum job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .metrics import auc_from_counts
from .ranking import MAX_BROADCAST_ROWS, attach, rows_up_to

DEFAULT_WINDOW = 3
DEFAULT_AUC_ALERT = 0.65
DEFAULT_PSI_LIMIT = 0.25


def period_index(df: DataFrame, period_col: str = "period") -> DataFrame:
    """Distinct periods with their 0-based position in text order.

    The distinct-period frame is bounded by the calendar (hundreds of rows), so the
    un-partitioned ranking window runs on a tiny input.
    """
    p = df.select(F.col(period_col).cast("string").alias("period")).where(
        F.col("period").isNotNull()).distinct()
    return p.select("period", (F.row_number().over(Window.orderBy("period")) - 1).alias("idx"))


def rolling_window_members(df: DataFrame, window: int = DEFAULT_WINDOW,
                           period_col: str = "period") -> DataFrame:
    """N-1: ``(anchor, member)`` — each period with the previous ``window − 1`` present periods."""
    if window < 1:
        raise ValueError("window must be >= 1")
    idx = period_index(df, period_col)
    fan = idx.select(F.col("period").alias("member"),
                     F.explode(F.sequence(F.col("idx"), F.col("idx") + window - 1)).alias("aidx"))
    anchors = idx.select(F.col("period").alias("anchor"), F.col("idx").alias("aidx"))
    return fan.join(anchors, "aidx", "inner").select("anchor", "member")


def rolling_auc(df: DataFrame, label_col: str = "label", score_col: str = "pd",
                period_col: str = "period", window: int = DEFAULT_WINDOW) -> DataFrame:
    """M-8: per period, AUC over its window, n_obs, n_defaults; NULL AUC for one class.

    Periods are counted first (one job): window members are broadcast while they are within the bound.
    """
    y = F.col(label_col).cast("long")
    counts = (df.where(F.col(period_col).isNotNull())
              .groupBy(F.col(period_col).cast("string").alias("member"),
                       F.col(score_col).cast("double").alias("_s"))
              .agg(F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg")))
    members = rolling_window_members(df, window, period_col)
    periods = rows_up_to(df.select(period_col).where(F.col(period_col).isNotNull()).distinct())
    few = periods * window <= MAX_BROADCAST_ROWS
    fanned = counts.join(F.broadcast(members) if few else members, "member", "inner").select(
        F.col("anchor").alias("period"), "_s", "_pos", "_neg")
    a = auc_from_counts(fanned, ["period"], max_groups=periods)
    return a.select("period", F.col("auc"), (F.col("n_pos") + F.col("n_neg")).alias("n_obs"),
                    F.col("n_pos").alias("n_defaults"))


def latest_valid(rolling: DataFrame) -> DataFrame:
    """N-10: the last non-null AUC in period order."""
    return rolling.where(F.col("auc").isNotNull()).agg(
        F.max_by("auc", "period").alias("latest_auc"))


def trend_slope(rolling: DataFrame) -> DataFrame:
    """N-11: OLS slope of the valid AUCs on 0..k−1 and the trend label."""
    valid = rolling.where(F.col("auc").isNotNull())
    ix = valid.select("auc", (F.row_number().over(Window.orderBy("period")) - 1).cast("double")
                      .alias("x"))
    agg = ix.agg(F.count(F.lit(1)).alias("k"), F.regr_slope("auc", "x").alias("s"))
    return agg.select(
        F.when(F.col("k") >= 2, F.round("s", 6)).alias("slope"),
        F.when(F.col("k") < 2, "insufficient_data").when(F.col("s") > 0, "improving")
        .otherwise("degrading").alias("trend"))


def perf_drift(df: DataFrame, label_col: str = "label", score_col: str = "pd",
               period_col: str = "period", window: int = DEFAULT_WINDOW,
               auc_alert_threshold: float = DEFAULT_AUC_ALERT, rolling: DataFrame | None = None) -> DataFrame:
    """M-9: latest AUC, slope, trend and alert (latest AUC below the threshold).

    ``rolling``: the stored result of ``rolling_auc`` where the caller has it; otherwise it is found once and
    stored (a row per period), as it is read twice."""
    r = rolling if rolling is not None else rolling_auc(
        df, label_col, score_col, period_col, window).checkpoint(eager=True)
    lv = latest_valid(r)
    ts = trend_slope(r)
    out = attach(lv, ts)
    return out.select(
        F.round("latest_auc", 6).alias("latest_auc"), "slope", "trend",
        F.lit(float(auc_alert_threshold)).alias("auc_alert_threshold"),
        F.coalesce(F.col("latest_auc") < auc_alert_threshold, F.lit(False)).alias("alert"))


def high_drift_features(feature_drift: DataFrame, limit: float = DEFAULT_PSI_LIMIT) -> DataFrame:
    """W-8: features whose PSI exceeds ``limit``."""
    return feature_drift.where(F.col("psi") > limit)


def monitoring_report(feature_drift: DataFrame, score_drift: DataFrame | None,
                      perf: DataFrame | None) -> DataFrame:
    """M-11: ``(check, name, metric, value, severity)`` for every statistic computed.

    A missing score column skips score drift; missing labels / periods skip
    performance drift (the reference passes an empty series on instead).
    """
    fd = feature_drift.select(
        F.lit("feature_drift").alias("check"), F.col("feature").alias("name"), "severity",
        "psi", "ks_statistic", "ks_p_value").unpivot(
        ["check", "name", "severity"], ["psi", "ks_statistic", "ks_p_value"], "metric", "value")
    parts = [fd]
    if score_drift is not None:
        parts.append(score_drift.select(
            F.lit("score_drift").alias("check"), F.lit("score").alias("name"), "severity",
            "psi", "ks_statistic", "ks_p_value", "mean_shift").unpivot(
            ["check", "name", "severity"], ["psi", "ks_statistic", "ks_p_value", "mean_shift"],
            "metric", "value"))
    if perf is not None:
        parts.append(perf.select(
            F.lit("perf_drift").alias("check"), F.lit("auc").alias("name"),
            F.when(F.col("alert"), "alert").otherwise("ok").alias("severity"),
            "latest_auc", "slope").unpivot(
            ["check", "name", "severity"], ["latest_auc", "slope"], "metric", "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("check", "name", "metric", F.col("value").cast("double"), "severity")
