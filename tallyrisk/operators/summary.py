"""Per-loan performance summary (A-1) and its join onto origination (J-2),
plus loan-month performance features joined to their origination terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import to_double
from ..functions.features import build_features


def perf_summary(perf: DataFrame, loan_col: str = "loan_sequence_number",
                 period_col: str = "reporting_month") -> DataFrame:
    """A-1: max loan age, last non-null UPB in period order, max delinquency status.

    Status text such as 'XX' is NULL. A missing input column skips its aggregate.
    Ordering is by the parsed month (T2), ties broken by the larger UPB.
    """
    aggs = []
    if "loan_age" in perf.columns:
        aggs.append(F.max(to_double(F.col("loan_age"))).alias("max_loan_age"))
    if "current_actual_upb" in perf.columns:
        upb = to_double(F.col("current_actual_upb"))
        aggs.append(F.max_by(upb, F.when(upb.isNotNull(), F.struct(F.col(period_col), upb)))
                    .alias("latest_upb"))
    if "current_delinquency_status" in perf.columns:
        aggs.append(F.max(to_double(F.col("current_delinquency_status"))).alias("max_dpd"))
    if not aggs:
        raise ValueError("no summarisable performance column present")
    return perf.groupBy(loan_col).agg(*aggs)


def loan_summary_join(orig: DataFrame, perf: DataFrame,
                      loan_col: str = "loan_sequence_number") -> DataFrame:
    """J-2: origination left-joined with the per-loan summary (one row per origination row)."""
    return orig.join(perf_summary(perf, loan_col), loan_col, "left")


def performance_features(perf: DataFrame, orig: DataFrame, loan_col: str = "loan_id",
                         keep: list[str] | None = None) -> DataFrame:
    """F-11..F-18 per loan-month, with origination terms attached by loan id.

    The reference attaches these by row position; the join on the loan id is the
    deliberate correction (one row per loan-month, never dropped).
    """
    terms = orig.select(loan_col, "orig_upb", "orig_interest_rate", "orig_loan_term")
    j = perf.join(terms, loan_col, "left")
    return build_features(j, ["performance"], keep=keep or [loan_col, "reporting_month"],
                          bounds={})
