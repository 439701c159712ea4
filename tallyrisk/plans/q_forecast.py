"""Queries: delinquency-rate series, trend fit and forecast, alignment and errors, breach,
tail, history ∪ future, semi-join, seasonal forecast (A-2, L-11..L-13, J-6, M-10, W-6, W-7,
N-12, U-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as FC
from . import bindings as B
from .catalog import query
from .oracle_views import six_digit_period, with_views

_TP = "lpad(CAST(TRY_CAST(TRY_CAST(trim(monthly_reporting_period) AS DOUBLE) AS BIGINT) AS VARCHAR), 6, '0')"
_TS = {
    "tsr": f"""SELECT {six_digit_period(_TP)} AS ds,
                CASE WHEN coalesce(TRY_CAST(trim(NULLIF(trim(current_delinquency_status), '')) AS DOUBLE), 0) > 0
                     THEN 1 ELSE 0 END AS d FROM v_perf_tape""",
    "ts": """SELECT ds, count(*) AS n_loans, sum(d) AS n_delinquent,
               least(greatest(sum(d) / greatest(count(*), 1), 0.0), 1.0) AS y
             FROM tsr WHERE ds IS NOT NULL GROUP BY ds""",
    "tx": "SELECT ds, least(greatest(coalesce(y, 0.0), 0.0), 1.0) AS y, row_number() OVER (ORDER BY ds) - 1 AS x FROM ts",
    "coef": """SELECT count(*) AS n, min(ds) AS start, max(ds) AS last_ds,
                 CASE WHEN count(*) >= 2 THEN regr_slope(y, x) ELSE 0.0 END AS slope,
                 CASE WHEN count(*) >= 2 THEN regr_intercept(y, x) WHEN count(*) = 1 THEN min(y) ELSE 0.0 END AS intercept
               FROM tx""",
    "fit": """SELECT coef.*, CASE WHEN coef.n >= 2 THEN greatest(
                 (SELECT stddev_pop(tx.y - (coef.intercept + coef.slope * tx.x)) FROM tx), 0.01) ELSE 0.01 END AS band
              FROM coef""",
    "fut": """SELECT CAST(unnest(generate_series(CAST(last_ds AS TIMESTAMP) + INTERVAL 1 MONTH,
                                               CAST(last_ds AS TIMESTAMP) + INTERVAL 30 MONTH, INTERVAL 1 MONTH)) AS DATE) AS ds
              FROM fit""",
    "frame": "SELECT ds FROM ts UNION ALL SELECT ds FROM fut",
    "fc0": """SELECT frame.ds, least(greatest(fit.intercept + fit.slope *
                 ((year(frame.ds) - year(fit.start)) * 12 + month(frame.ds) - month(fit.start)), 0.0), 1.0) AS yhat,
                 fit.band FROM frame, fit""",
    "fc": """SELECT ds, yhat, greatest(yhat - band, 0.0) AS yhat_lower, least(yhat + band, 1.0) AS yhat_upper FROM fc0""",
}


def _ts(spark, d):
    return FC.delinquency_rate_ts(B.perf_tape(spark, d))


def _fit_fc(spark, d):
    ts = _ts(spark, d)
    fit = FC.trend_fit(ts)
    fc = FC.trend_forecast(FC.history_plus_future(ts, fit, FC.DEFAULT_HORIZON), fit)
    return ts, fit, fc


def _r(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("delinquency_rate_ts", with_views(
    "SELECT ds, CAST(n_loans AS BIGINT) AS n_loans, CAST(n_delinquent AS BIGINT) AS n_delinquent, "
    "round(y, 6) AS y FROM ts", "v_perf_tape", extra=_TS, dates=["ds"]))
def q_delinquency_rate_ts(spark, d):
    return _r(_ts(spark, d), ["y"])


@query("trend_fit", with_views(
    "SELECT CAST(n AS BIGINT) AS n, start, last_ds, round(slope, 6) AS slope, round(intercept, 6) AS intercept, "
    "round(band, 6) AS band FROM fit", "v_perf_tape", extra=_TS, dates=["start", "last_ds"]))
def q_trend_fit(spark, d):
    fit = FC.trend_fit(_ts(spark, d))
    return _r(fit.withColumn("n", F.col("n").cast("bigint")), ["slope", "intercept", "band"])


@query("trend_forecast", with_views(
    "SELECT ds, round(yhat, 6) AS yhat, round(yhat_lower, 6) AS yhat_lower, round(yhat_upper, 6) AS yhat_upper FROM fc",
    "v_perf_tape", extra=_TS, dates=["ds"]))
def q_trend_forecast(spark, d):
    _, _, fc = _fit_fc(spark, d)
    return _r(fc, ["yhat", "yhat_lower", "yhat_upper"])


@query("history_plus_future", with_views("SELECT ds FROM frame", "v_perf_tape", extra=_TS, dates=["ds"]))
def q_history_plus_future(spark, d):
    ts = _ts(spark, d)
    return FC.history_plus_future(ts, FC.trend_fit(ts), FC.DEFAULT_HORIZON)


@query("forecast_tail", with_views(
    "SELECT strftime(ds, '%Y-%m-%d') AS ds, round(yhat, 6) AS yhat, round(yhat_lower, 6) AS yhat_lower, "
    "round(yhat_upper, 6) AS yhat_upper FROM fc WHERE ds > (SELECT last_ds FROM fit)", "v_perf_tape", extra=_TS))
def q_forecast_tail(spark, d):
    _, fit, fc = _fit_fc(spark, d)
    return _r(FC.forecast_tail(fc, fit), ["yhat", "yhat_lower", "yhat_upper"])


@query("in_history_semi", with_views(
    "SELECT ds, round(yhat, 6) AS yhat, round(yhat_lower, 6) AS yhat_lower, round(yhat_upper, 6) AS yhat_upper "
    "FROM fc WHERE ds IN (SELECT ds FROM ts)", "v_perf_tape", extra=_TS, dates=["ds"]))
def q_in_history_semi(spark, d):
    ts, _, fc = _fit_fc(spark, d)
    return _r(FC.in_history(fc, ts), ["yhat", "yhat_lower", "yhat_upper"])


@query("actual_forecast_align", with_views(
    "SELECT ts.ds, round(ts.y, 6) AS y, round(fc.yhat, 6) AS yhat FROM ts JOIN fc USING (ds)",
    "v_perf_tape", extra=_TS, dates=["ds"]))
def q_actual_forecast_align(spark, d):
    ts, _, fc = _fit_fc(spark, d)
    al = ts.select("ds", "y").join(fc.select("ds", "yhat"), "ds", "inner")
    return _r(al, ["y", "yhat"])


@query("prediction_error", with_views("""
SELECT round(avg(abs(ts.y - fc.yhat)), 6) AS mae, round(sqrt(avg((ts.y - fc.yhat) * (ts.y - fc.yhat))), 6) AS rmse,
       round(avg(abs((ts.y - fc.yhat) / NULLIF(ts.y, 0.0))) * 100, 6) AS mape, CAST(count(*) AS BIGINT) AS n_aligned
FROM ts JOIN fc USING (ds)""", "v_perf_tape", extra=_TS))
def q_prediction_error(spark, d):
    ts, _, fc = _fit_fc(spark, d)
    return FC.actual_forecast_mae(ts, fc)


@query("forecast_breach", with_views(
    "SELECT CAST(count(*) FILTER (WHERE yhat >= 0.2) AS BIGINT) AS n_breach, CAST(count(*) AS BIGINT) AS n_rows, "
    "min(ds) FILTER (WHERE yhat >= 0.2) AS first_breach FROM fc", "v_perf_tape", extra=_TS,
    dates=["first_breach"]))
def q_forecast_breach(spark, d):
    _, _, fc = _fit_fc(spark, d)
    return FC.forecast_breach(fc)


@query("seasonal_forecast")
def q_seasonal_forecast(spark, d):
    """L-13 (re-aimed; rows only): trend + changepoints + yearly seasonality, history + 30 months."""
    return FC.seasonal_forecast(_ts(spark, d))


@query("seasonal_forecast_segments")
def q_seasonal_forecast_segments(spark, d):
    """L-13 per segment (rows only): one seasonal model for every current interest rate of the tape."""
    segment = ["current_interest_rate"]
    ts = FC.delinquency_rate_ts(B.perf_tape(spark, d), group_cols=segment)
    return FC.seasonal_forecast(ts, group_cols=segment)
