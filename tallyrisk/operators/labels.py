"""Forward-looking default label (J-1, W-1, W-4, J-7, U-3) and label summaries (A-11, P-11).

The label for a loan-month ``t`` is 1 when the same loan has a bad month
(dpd ≥ threshold) in ``(t, t + horizon months]``. The reference builds it as
an observation × bad-event self-merge; here it is one RANGE window over the
*distinct* (loan, month) keys, so a loan with millions of duplicate rows only
contributes its distinct months to the window, and the result is joined back
to every input row (AQE splits a hot join key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import ZERO_BALANCE_DEFAULT_CODES

DEFAULT_HORIZON = 12
DEFAULT_THRESHOLD = 60


def _order_key(df: DataFrame, date_col: str) -> tuple[Column, bool]:
    dt = df.schema[date_col].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(date_col).cast("timestamp")), True
    return F.unix_date(F.col(date_col).cast("date")), False


def forward_default_label(panel: DataFrame, loan_col: str = "loan_id",
                          date_col: str = "reporting_month", dpd_col: str = "dpd",
                          horizon: int = DEFAULT_HORIZON, threshold: float = DEFAULT_THRESHOLD,
                          label_col: str = "label") -> DataFrame:
    """Add ``label_col`` (int 0/1) to every row of ``panel``; row count unchanged."""
    if horizon < 1:
        raise ValueError("horizon must be >= 1 month")
    order, is_ts = _order_key(panel, date_col)
    bad = F.coalesce((F.col(dpd_col) >= F.lit(threshold)).cast("int"), F.lit(0))
    # Distinct keys, one row each: pre-aggregated before the window's shuffle. (No NULL
    # filter here: NULL keys never match the join back, and an unfiltered branch lets the
    # planner reuse the panel's exchange instead of computing the panel twice.)
    keys = (panel.groupBy(F.col(loan_col).alias("_loan"), F.col(date_col).alias("_d"))
            .agg(F.max(bad).alias("_bad")))
    korder, _ = _order_key(keys, "_d")
    keys = keys.withColumn("_o", korder)
    w = (Window.partitionBy("_loan").orderBy("_o")
         .rangeBetween(1, Window.unboundedFollowing))
    nxt = F.min(F.when(F.col("_bad") == 1, F.col("_d"))).over(w)
    if is_ts:
        limit = F.col("_d") + F.make_interval(months=F.lit(horizon))
    else:
        limit = F.add_months(F.col("_d"), horizon)
    lab = keys.select("_loan", "_d", nxt.alias("_next"))
    lab = lab.select("_loan", "_d",
                     F.coalesce((F.col("_next") <= limit).cast("int"), F.lit(0)).alias("_lab"))
    out = panel.join(lab, (panel[loan_col] == lab["_loan"]) & (panel[date_col] == lab["_d"]), "left")
    return out.select(*[panel[c] for c in panel.columns],
                      F.coalesce(F.col("_lab"), F.lit(0)).cast("int").alias(label_col))


def forward_default_label_naive(panel: DataFrame, loan_col: str = "loan_id",
                                date_col: str = "reporting_month", dpd_col: str = "dpd",
                                horizon: int = DEFAULT_HORIZON,
                                threshold: float = DEFAULT_THRESHOLD,
                                label_col: str = "label") -> DataFrame:
    """Test twin of J-1 in the reference's shape: bad events (W-1) self-joined on the
    interval (W-4), distinct flagged keys (U-3), left-merged back with NULL → 0 (J-7).

    Quadratic per loan; used only to cross-check :func:`forward_default_label`.
    """
    bad = panel.where(F.col(dpd_col) >= threshold).select(
        F.col(loan_col).alias("_bl"), F.col(date_col).alias("_bd"))
    obs = panel.select(F.col(loan_col).alias("_ol"), F.col(date_col).alias("_od")).distinct()
    cond = ((obs["_ol"] == bad["_bl"]) & (bad["_bd"] > obs["_od"])
            & (bad["_bd"] <= F.add_months(obs["_od"], horizon)))
    flagged = obs.join(bad, cond, "inner").select("_ol", "_od").distinct()
    out = panel.join(flagged, (panel[loan_col] == flagged["_ol"]) & (panel[date_col] == flagged["_od"]),
                     "left")
    return out.select(*[panel[c] for c in panel.columns],
                      F.col("_ol").isNotNull().cast("int").alias(label_col))


def bad_events(panel: DataFrame, dpd_col: str = "dpd",
               threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """W-1: rows with ``dpd >= threshold``."""
    return panel.where(F.col(dpd_col) >= threshold)


def label_balance(labeled: DataFrame, label_col: str = "label") -> DataFrame:
    """A-11: positives, total and percent positive (one row)."""
    return labeled.agg(
        F.sum(F.col(label_col)).cast("bigint").alias("positives"),
        F.count(F.lit(1)).cast("bigint").alias("total"),
        F.round(F.try_divide(F.sum(F.col(label_col)) * 100.0, F.count(F.lit(1))), 6).alias("percent"),
    )


def default_rate_by_month(labeled: DataFrame, date_col: str = "reporting_month",
                          label_col: str = "label") -> DataFrame:
    """12-month-forward default rate per calendar month (the flagship report)."""
    return (labeled.groupBy(F.col(date_col).alias("month"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_obs"),
                 F.sum(label_col).cast("bigint").alias("n_default"),
                 F.round(F.avg(label_col), 6).alias("default_rate")))


def default_label(df: DataFrame, max_dpd_col: str = "max_dpd",
                  zero_balance_col: str = "zero_balance_code", threshold: float = 3) -> Column:
    """P-11: ``max_dpd >= 3`` when that column exists, else a default zero-balance code.

    The reference's third fallback (a random 5 % label) is not reproduced: it
    fabricates data, so a frame with neither column is an error.
    """
    if max_dpd_col in df.columns:
        return F.coalesce((F.col(max_dpd_col) >= threshold).cast("int"), F.lit(0))
    if zero_balance_col in df.columns:
        code = F.col(zero_balance_col).cast("string")
        return F.coalesce(code.isin(*ZERO_BALANCE_DEFAULT_CODES).cast("int"), F.lit(0))
    raise ValueError(f"neither {max_dpd_col!r} nor {zero_balance_col!r} present: no label source")
