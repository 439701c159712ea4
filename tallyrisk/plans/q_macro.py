"""Queries: monthly resampling, as-of fill, series pivot / alignment, macro join,
null-macro report, year-over-year macro feature (P-9, J-3, J-4, J-5, A-9, A-10, F-19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import macro as MC
from . import bindings as B
from .catalog import query
from .oracle_views import with_views

SERIES = ["urgent", "high", "medium", "not_specified", "low"]

_CAL = """SELECT series_id, CAST(unnest(generate_series(CAST(min(date_trunc('month', date)) AS TIMESTAMP),
                 CAST(max(date_trunc('month', date)) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
          FROM {src} GROUP BY series_id"""
_MEAN = {
    "cal": _CAL.format(src="v_series_daily"),
    "mm": """SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS month, avg(value) AS value
             FROM v_series_daily GROUP BY 1, 2""",
    "monthly": "SELECT cal.series_id, cal.month, mm.value FROM cal LEFT JOIN mm USING (series_id, month)",
    "wide": "SELECT strftime(month, '%Y-%m') AS period, " + ", ".join(
        f"max(value) FILTER (WHERE series_id = '{s}') AS {s}" for s in SERIES)
    + " FROM monthly GROUP BY 1",
}


def monthly_mean(spark, d):
    return MC.resample_monthly(B.series_daily(spark, d), "mean")


def macro_wide(spark, d):
    return MC.series_pivot(monthly_mean(spark, d), SERIES)


@query("resample_monthly", with_views(
    "SELECT series_id, month, round(value, 6) AS value FROM monthly", "v_series_daily",
    extra=_MEAN, dates=["month"]))
def q_resample_monthly(spark, d):
    m = monthly_mean(spark, d)
    return m.select("series_id", "month", F.round("value", 6).alias("value"))


@query("asof_ffill", with_views("""
SELECT cal.series_id, cal.month, round(o.value, 6) AS value
FROM cal ASOF LEFT JOIN v_series_q o ON cal.series_id = o.series_id AND cal.month >= o.date
""", "v_series_q", extra={"cal": _CAL.format(src="v_series_q")}, dates=["month"]))
def q_asof_ffill(spark, d):
    m = MC.resample_monthly(B.series_quarterly(spark, d), "ffill")
    return m.select("series_id", "month", F.round("value", 6).alias("value"))


@query("asof_ffill_daily", with_views("""
SELECT cal.series_id, cal.month, round(o.value, 6) AS value
FROM cal ASOF LEFT JOIN v_series_daily o ON cal.series_id = o.series_id AND cal.month >= o.date
""", "v_series_daily", extra={"cal": _MEAN["cal"]}, dates=["month"]))
def q_asof_ffill_daily(spark, d):
    """J-4 over the whole irregular series, most of it observed after the first of a month."""
    m = MC.resample_monthly(B.series_daily(spark, d), "ffill")
    return m.select("series_id", "month", F.round("value", 6).alias("value"))


_ROUNDED = ", ".join(f"round({s}, 6) AS {s}" for s in SERIES)


@query("series_pivot", with_views(f"SELECT period, {_ROUNDED} FROM wide", "v_series_daily", extra=_MEAN))
def q_series_pivot(spark, d):
    w = macro_wide(spark, d)
    return w.select("period", *[F.round(s, 6).alias(s) for s in SERIES])


@query("series_outer_align", with_views(f"""
SELECT period, {_ROUNDED} FROM (
  SELECT coalesce(a.period, b.period) AS period, a.urgent, a.high, a.medium, a.not_specified, b.low
  FROM (SELECT period, urgent, high, medium, not_specified FROM wide WHERE coalesce(urgent, high, medium, not_specified) IS NOT NULL
        OR period IN (SELECT strftime(month, '%Y-%m') FROM monthly WHERE series_id <> 'low')) a
  FULL OUTER JOIN (SELECT period, low FROM wide WHERE period IN
        (SELECT strftime(month, '%Y-%m') FROM monthly WHERE series_id = 'low')) b ON a.period = b.period)
""", "v_series_daily", extra=_MEAN))
def q_series_outer_align(spark, d):
    """J-5 within one daily family; ``series_outer_align_families`` aligns two."""
    w = macro_wide(spark, d)
    return w.select("period", *[F.round(s, 6).alias(s) for s in SERIES])


_FILLED = {
    "calq": _CAL.format(src="v_series_q"),
    "filled": """SELECT calq.series_id, calq.month, o.value FROM calq
                 ASOF LEFT JOIN v_series_q o ON calq.series_id = o.series_id AND calq.month >= o.date""",
    "wide_q": "SELECT strftime(month, '%Y-%m') AS period, " + ", ".join(
        f"max(value) FILTER (WHERE series_id = '{s}') AS {s}_q" for s in SERIES)
    + " FROM filled GROUP BY 1",
}


@query("series_outer_align_families", with_views(
    "SELECT coalesce(a.period, b.period) AS period, "
    + ", ".join(f"round(a.{s}, 6) AS {s}" for s in SERIES) + ", "
    + ", ".join(f"round(b.{s}_q, 6) AS {s}_q" for s in SERIES)
    + " FROM wide a FULL OUTER JOIN wide_q b ON a.period = b.period",
    "v_series_daily", "v_series_q", extra={**_MEAN, **_FILLED}))
def q_series_outer_align_families(spark, d):
    """J-5: the monthly means of the daily family and the quarterly family filled forward, each with
    its own span, as one long union and one pivot."""
    filled = MC.resample_monthly(B.series_quarterly(spark, d), "ffill")
    filled = filled.withColumn("series_id", F.concat("series_id", F.lit("_q")))
    names = [*SERIES, *(f"{s}_q" for s in SERIES)]
    w = MC.series_pivot(monthly_mean(spark, d).unionByName(filled), names)
    return w.select("period", *[F.round(s, 6).alias(s) for s in names])


_JOIN_SQL = f"""SELECT o.loan_id, o.first_payment_date, {", ".join(f"round(w.{s}, 6) AS {s}" for s in SERIES)}
FROM v_orig o LEFT JOIN wide w ON strftime(o.first_payment_month, '%Y-%m') = w.period"""


def joined(spark, d):
    loans = B.orig(spark, d).select("loan_id", "first_payment_date")
    return MC.macro_join(loans, macro_wide(spark, d), "first_payment_date")


@query("macro_join", with_views(_JOIN_SQL, "v_orig", "v_series_daily", extra=_MEAN))
def q_macro_join(spark, d):
    j = joined(spark, d)
    return j.select("loan_id", "first_payment_date", *[F.round(s, 6).alias(s) for s in SERIES])


@query("null_macro_rows", with_views(
    "SELECT CAST(count(*) FILTER (WHERE " + " OR ".join(f"{s} IS NULL" for s in SERIES)
    + ") AS BIGINT) AS rows_with_null_macro, CAST(count(*) AS BIGINT) AS rows FROM j",
    "v_orig", "v_series_daily", extra={**_MEAN, "j": _JOIN_SQL}))
def q_null_macro_rows(spark, d):
    return MC.null_macro_rows(joined(spark, d), SERIES)


@query("macro_features", with_views("""
SELECT a.period, round(a.high, 6) AS hpi, round(a.high / b.high - 1, 6) AS hpi_yoy,
       round(a.urgent, 6) AS unemployment_rate, round(a.medium, 6) AS mortgage_rate_30yr
FROM wide a LEFT JOIN wide b
  ON b.period = strftime(CAST(a.period || '-01' AS DATE) - INTERVAL 12 MONTH, '%Y-%m')
""", "v_series_daily", extra=_MEAN))
def q_macro_features(spark, d):
    """F-19: the macro placeholders filled from the monthly frame (hpi_yoy = HPI / lag 12 − 1)."""
    w = MC.yoy(macro_wide(spark, d), "high", "hpi_yoy")
    return w.select("period", F.round("high", 6).alias("hpi"), F.round("hpi_yoy", 6).alias("hpi_yoy"),
                    F.round("urgent", 6).alias("unemployment_rate"),
                    F.round("medium", 6).alias("mortgage_rate_30yr"))
