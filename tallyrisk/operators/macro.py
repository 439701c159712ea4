"""Macro series: monthly resampling, as-of forward fill, pivot, macro join
(P-9, J-3, J-4, J-5, A-9, A-10, F-19).

Series arrive long: ``(series_id, date, value)``. Every step first reduces the
observations to at most one row per (series, month) — an aggregate with
map-side combine — so windows and joins only ever see calendar-sized frames
(#series × #months), whatever the observation frequency. That bound is what
makes the monthly frame safe to broadcast into the loan-level macro join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import period_text
from .ranking import MAX_BROADCAST_ROWS, rows_up_to

RESAMPLE_METHODS = ("mean", "ffill")


def _calendar(obs: DataFrame) -> DataFrame:
    """Every month from the first to the last observation's month, per series."""
    rng = obs.groupBy("series_id").agg(F.min(F.trunc("date", "MM")).alias("m0"),
                                       F.max(F.trunc("date", "MM")).alias("m1"))
    return rng.select("series_id", F.explode(F.sequence(
        "m0", "m1", F.expr("INTERVAL 1 MONTH"))).alias("month"))


def resample_mean(obs: DataFrame) -> DataFrame:
    """P-9 ``mean``: calendar-month mean of non-null values; empty months NULL."""
    o = obs.where(F.col("date").isNotNull())
    means = o.groupBy("series_id", F.trunc("date", "MM").alias("month")).agg(
        F.avg("value").alias("value"))
    return _calendar(o).join(means, ["series_id", "month"], "left")


def asof_ffill(obs: DataFrame) -> DataFrame:
    """J-4 / P-9 ``ffill``: value of the last observation at or before each month start.

    An observation dated on the 1st feeds its own month, any later one the next
    month; per (series, target month) only the latest observation is kept
    (a NULL value is kept too — pandas pad semantics), then the calendar is
    forward-filled. The window runs over (series, month) rows only.
    """
    o = obs.where(F.col("date").isNotNull())
    d = F.col("date").cast("date")
    target = F.when(F.dayofmonth(d) == 1, F.trunc(d, "MM")).otherwise(
        F.add_months(F.trunc(d, "MM"), 1))
    last_per_target = o.groupBy("series_id", target.alias("month")).agg(
        F.max_by(F.struct(F.col("value").alias("v")), F.col("date")).alias("obs"))
    cal = _calendar(o).join(last_per_target, ["series_id", "month"], "left")
    w = (Window.partitionBy("series_id").orderBy("month")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return cal.select("series_id", "month",
                      F.last("obs", ignorenulls=True).over(w).getField("v").alias("value"))


def resample_monthly(obs: DataFrame, method: str) -> DataFrame:
    """P-9: ``(series_id, month DATE, value)`` by ``mean`` or ``ffill``."""
    if method == "mean":
        return resample_mean(obs)
    if method == "ffill":
        return asof_ffill(obs)
    raise ValueError(f"Unknown resample method {method!r}; expected one of {RESAMPLE_METHODS}")


def resample_by_method(obs: DataFrame, methods: dict[str, str]) -> DataFrame:
    """Resample each series with its own method (a per-series configuration)."""
    parts = []
    for m in sorted(set(methods.values())):
        ids = [s for s, mm in methods.items() if mm == m]
        parts.append(resample_monthly(obs.where(F.col("series_id").isin(ids)), m))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def series_pivot(monthly: DataFrame, series: list[str]) -> DataFrame:
    """A-9 / J-5: one row per month present in any series, one column per series."""
    return (monthly.groupBy(period_text(F.col("month")).alias("period"))
            .pivot("series_id", series).agg(F.first("value", ignorenulls=True)))


def yoy(monthly_wide: DataFrame, col: str, out: str) -> DataFrame:
    """F-19 helper: ``col / col 12 calendar months earlier − 1`` (a calendar self-join)."""
    prev = monthly_wide.select(
        period_text(F.add_months(F.to_date(F.concat("period", F.lit("-01"))), 12)).alias("period"),
        F.col(col).alias("_prev"))
    return monthly_wide.join(prev, "period", "left").withColumn(
        out, F.try_divide(F.col(col), F.col("_prev")) - 1).drop("_prev")


def macro_join(loans: DataFrame, macro: DataFrame, date_col: str,
               parse: Column | None = None) -> DataFrame:
    """J-3: left join of the monthly macro frame on the loan's month.

    Rows are preserved; months out of range or unparsable get NULL macros. The
    macro frame should be calendar-sized (#months rows); its rows are counted, and it
    is broadcast within the bound and left to the planner beyond it.
    """
    if date_col not in loans.columns:
        raise KeyError(f"date column {date_col!r} not in frame")
    from ..functions.clean import parse_period

    p = parse if parse is not None else period_text(parse_period(F.col(date_col)))
    keyed = loans.withColumn("_period", p)
    m = macro.withColumnRenamed("period", "_period")
    few = rows_up_to(m) <= MAX_BROADCAST_ROWS
    return keyed.join(F.broadcast(m) if few else m, "_period", "left").drop("_period")


def null_macro_rows(joined: DataFrame, macro_cols: list[str]) -> DataFrame:
    """A-10: rows with at least one NULL macro column, and the total."""
    anynull = F.lit(False)
    for c in macro_cols:
        anynull = anynull | F.col(c).isNull()
    return joined.agg(F.count_if(anynull).cast("bigint").alias("rows_with_null_macro"),
                      F.count(F.lit(1)).cast("bigint").alias("rows"))
