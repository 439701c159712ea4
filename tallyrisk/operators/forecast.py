"""Delinquency-rate series and trend forecasts (A-2, L-11..L-13, J-6, M-10, W-6, W-7, N-12, U-2).

The monthly series is an aggregate of the loan-month panel (one row per month,
per segment), so fitting is a group-by with ``regr_slope`` / ``regr_intercept``
and ``stddev_pop`` of the residuals — many segments fit in one job. Forecast
months are generated from the horizon with ``sequence`` + ``explode``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import to_double, with_tape_period

DEFAULT_HORIZON = 30
MIN_BAND = 0.01
BREACH_THRESHOLD = 0.20


def _join(df: DataFrame, per_segment: DataFrame, g: list[str]) -> DataFrame:
    """Attach per-segment fit rows to ``df``: a broadcast scalar when unsegmented; with
    segments the row count follows the data, so the join strategy is left to AQE."""
    from .ranking import attach

    return df.join(per_segment, g, "inner") if g else attach(df, per_segment)


def delinquency_rate_ts(perf: DataFrame, period_col: str = "monthly_reporting_period",
                        status_col: str = "current_delinquency_status",
                        group_cols: list[str] | None = None) -> DataFrame:
    """A-2: per month ``n_loans``, ``n_delinquent``, ``y = n_del / max(n, 1)`` in [0, 1].

    The period is parsed as a tape period (P-7); unparsable rows are dropped (W-3);
    a missing or non-numeric status counts as current.
    """
    g = group_cols or []
    dlq = (F.coalesce(to_double(F.col(status_col)), F.lit(0.0)) > 0).cast("int")
    p = perf.select(*[F.col(c) for c in g], F.col(period_col), dlq.alias("_d"))
    p = with_tape_period(p, period_col, "ds").where(F.col("ds").isNotNull())
    agg = p.groupBy(*[F.col(c) for c in g], "ds").agg(
        F.count(F.lit(1)).alias("n_loans"), F.sum("_d").alias("n_delinquent"))
    y = F.least(F.greatest(F.col("n_delinquent") / F.greatest(F.col("n_loans"), F.lit(1)),
                           F.lit(0.0)), F.lit(1.0))
    return agg.select(*[F.col(c) for c in g], "ds", F.col("n_loans").cast("bigint"),
                      F.col("n_delinquent").cast("bigint"), y.alias("y"))


def trend_fit(ts: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """L-11: OLS of y on 0..n−1 (rows in date order) per segment.

    y is NULL→0 and clipped to [0, 1]; band = max(population std of residuals, 0.01);
    one point → flat at that value; ``start`` = first date (the forecast's origin).
    """
    g = group_cols or []
    y = F.least(F.greatest(F.coalesce(F.col("y"), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    w = Window.partitionBy(*[F.col(c) for c in g]) if g else Window.partitionBy(F.lit(0))
    # One row per month per segment: the window input is calendar-sized.
    t = ts.where(F.col("ds").isNotNull()).select(
        *[F.col(c) for c in g], "ds", y.alias("_y"),
        (F.row_number().over(w.orderBy("ds")) - 1).cast("double").alias("_x"))
    coef = t.groupBy(*[F.col(c) for c in g]).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope("_y", "_x").alias("_b"),
        F.regr_intercept("_y", "_x").alias("_a"), F.first("_y").alias("_y0"),
        F.min("ds").alias("start"), F.max("ds").alias("last_ds"))
    coef = coef.select(
        *[F.col(c) for c in g], "n", "start", "last_ds",
        F.when(F.col("n") >= 2, F.col("_b")).otherwise(F.lit(0.0)).alias("slope"),
        F.when(F.col("n") >= 2, F.col("_a")).when(F.col("n") == 1, F.col("_y0"))
        .otherwise(F.lit(0.0)).alias("intercept"))
    res = _join(t, coef, g)
    band = res.groupBy(*[F.col(c) for c in g]).agg(
        F.stddev_pop(F.col("_y") - (F.col("intercept") + F.col("slope") * F.col("_x"))).alias("_sd"),
        F.max("n").alias("_n"))
    out = _join(coef, band, g)
    return out.select(*[F.col(c) for c in g], "n", "start", "last_ds", "slope", "intercept",
                      F.when(F.col("n") >= 2, F.greatest(F.col("_sd"), F.lit(MIN_BAND)))
                      .otherwise(F.lit(MIN_BAND)).alias("band"))


def future_months(fit: DataFrame, horizon: int = DEFAULT_HORIZON,
                  group_cols: list[str] | None = None) -> DataFrame:
    """U-2 future half / N-12: the ``horizon`` month starts after the last history month."""
    if horizon < 1:
        raise ValueError("horizon must be >= 1")
    g = group_cols or []
    first = F.add_months(F.trunc("last_ds", "MM"), 1)
    return fit.select(*[F.col(c) for c in g], F.explode(F.sequence(
        first, F.add_months(first, horizon - 1), F.expr("INTERVAL 1 MONTH"))).alias("ds"))


def history_plus_future(ts: DataFrame, fit: DataFrame, horizon: int = DEFAULT_HORIZON,
                        group_cols: list[str] | None = None) -> DataFrame:
    """U-2: history dates ∪ future month starts."""
    g = group_cols or []
    hist = ts.select(*[F.col(c) for c in g], "ds")
    return hist.unionByName(future_months(fit, horizon, g))


def trend_forecast(frame: DataFrame, fit: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """L-12: yhat = clip(intercept + slope · calendar months since start), band ± clipped.

    The fit index counts rows while the prediction counts calendar months (T13).
    """
    g = group_cols or []
    j = _join(frame, fit, g)
    idx = ((F.year("ds") - F.year("start")) * 12 + F.month("ds") - F.month("start")).cast("double")
    yhat = F.least(F.greatest(F.col("intercept") + F.col("slope") * idx, F.lit(0.0)), F.lit(1.0))
    j = j.select(*[F.col(c) for c in g], "ds", yhat.alias("yhat"), "band")
    return j.select(*[F.col(c) for c in g], "ds", "yhat",
                    F.greatest(F.col("yhat") - F.col("band"), F.lit(0.0)).alias("yhat_lower"),
                    F.least(F.col("yhat") + F.col("band"), F.lit(1.0)).alias("yhat_upper"))


def forecast_tail(fc: DataFrame, fit: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """N-12: the forecast rows after the history (the last ``horizon`` rows), ISO dates."""
    g = group_cols or []
    j = _join(fc, fit.select(*g, "last_ds"), g)
    return j.where(F.col("ds") > F.col("last_ds")).select(
        *[F.col(c) for c in g], F.date_format("ds", "yyyy-MM-dd").alias("ds"),
        "yhat", "yhat_lower", "yhat_upper")


def in_history(fc: DataFrame, ts: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """W-7: forecast rows whose date occurs in the history (left semi join)."""
    g = group_cols or []
    return fc.join(ts.select(*g, "ds"), g + ["ds"], "left_semi")


def actual_forecast_mae(ts: DataFrame, fc: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """J-6 + M-10: inner-align actual and predicted on the date, then MAE / RMSE / MAPE."""
    from .metrics import prediction_error

    g = group_cols or []
    al = ts.select(*g, "ds", "y").join(fc.select(*g, "ds", "yhat"), g + ["ds"], "inner")
    return prediction_error(al, "y", "yhat", g).join(
        al.groupBy(*g).agg(F.count(F.lit(1)).cast("bigint").alias("n_aligned")), g, "inner") \
        if g else attach_counts(prediction_error(al, "y", "yhat"), al)


def attach_counts(metrics: DataFrame, aligned: DataFrame) -> DataFrame:
    from .ranking import attach

    return attach(metrics, aligned.agg(F.count(F.lit(1)).cast("bigint").alias("n_aligned")))


def forecast_breach(fc: DataFrame, threshold: float = BREACH_THRESHOLD) -> DataFrame:
    """W-6: number of forecast rows with yhat ≥ threshold, of all, and the first breach date."""
    hit = F.col("yhat") >= threshold
    return fc.agg(F.count_if(hit).cast("bigint").alias("n_breach"),
                  F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                  F.min(F.when(hit, F.col("ds"))).alias("first_breach"))


# Prior scales of the seasonal model (fixed values of the reference's forecaster).
CHANGEPOINTS, CHANGEPOINT_RANGE, CHANGEPOINT_SCALE = 25, 0.8, 0.05
SEASON_ORDER, SEASON_SCALE = 3, 10.0


def seasonal_design(months, span: int, calendar_month):
    """L-13 design matrix over ``months`` since the start, and the kinds of its columns: constant, trend over
    [0, 1], hinges, yearly Fourier terms."""
    import numpy as np

    t = months / max(span, 1)
    n = min(CHANGEPOINTS, max(span - 1, 0))
    hinges = [np.maximum(t - CHANGEPOINT_RANGE * i / (n + 1), 0.0) for i in range(1, n + 1)]
    angle = [2 * np.pi * k * calendar_month / 12 for k in range(1, SEASON_ORDER + 1)]
    season = [f(a) for a in angle for f in (np.sin, np.cos)]
    kinds = ["base"] * 2 + ["hinge"] * len(hinges) + ["season"] * len(season)
    return np.column_stack([np.ones(len(t)), t, *hinges, *season]), kinds


def _penalised_fit(xx, xy, yy: float, n: int, kinds: list[str], rounds: int = 50):
    """Weights from sufficient statistics: sparse (Laplace) hinges, weak ridge seasons, free base.

    The Laplace prior is applied by reweighted ridge steps; the noise level follows the residuals.
    """
    import numpy as np

    scale = max((yy / n) ** 0.5, 1e-12)
    xy, yy = xy / scale, yy / scale ** 2
    hinge = np.array([k == "hinge" for k in kinds])
    ridge = np.where(hinge, 1.0 / CHANGEPOINT_SCALE ** 2,
                     np.array([1.0 / SEASON_SCALE ** 2 if k == "season" else 1e-9 for k in kinds]))
    noise, w = 0.01, np.zeros(len(kinds))
    for _ in range(rounds):
        w = np.linalg.solve(xx + np.diag(noise * ridge), xy)
        noise = max((yy - 2 * w @ xy + w @ xx @ w) / n, 1e-9)
        ridge = np.where(hinge, 1.0 / (CHANGEPOINT_SCALE * (np.abs(w) + 1e-6)), ridge)
    return w * scale


def _seasonal_fit(ds, y, horizon: int, interval: float):
    """One segment: dates of history and future, prediction with its band, in-sample MAE. None below 2 months."""
    import numpy as np

    order = np.argsort(ds)
    ds, y = ds[order], y[order]
    if len(ds) < 2:
        return None
    month = ds.astype("datetime64[M]").astype(int)
    dates = np.concatenate([ds, (month[-1] + 1 + np.arange(horizon)).astype("datetime64[M]").astype("datetime64[D]")])
    at = np.concatenate([month, month[-1] + 1 + np.arange(horizon)])
    x, kinds = seasonal_design((at - month[0]).astype(float), int(month[-1] - month[0]), (at % 12 + 1).astype(float))
    own = x[:len(y)]
    w = _penalised_fit(own.T @ own, own.T @ y, float(y @ y), len(y), kinds)
    fit = x @ w
    rest = y - fit[:len(y)]
    low, high = np.quantile(rest, [(1 - interval) / 2, 1 - (1 - interval) / 2])
    mae = np.abs(y - np.clip(fit[:len(y)], 0, 1)).mean()
    return dates, np.clip(fit, 0, 1), np.clip(fit + low, 0, 1), np.clip(fit + high, 0, 1), np.full(len(dates), mae)


def seasonal_forecast(ts: DataFrame, horizon: int = DEFAULT_HORIZON, interval: float = 0.8,
                      group_cols: list[str] | None = None) -> DataFrame:
    """L-13: piecewise-linear trend with sparse changepoints plus yearly seasonality per segment, interval from
    residual quantiles, and the in-sample MAE in every row. Needs >= 2 months: without segments fewer are an
    error, a segment with fewer gives no rows.

    Rows are first averaged per segment and date, so a segment holds its calendar and no more; segments are
    spread over the cluster and each is solved inside one task.
    """
    import numpy as np
    import pyarrow as pa

    if horizon < 1:
        raise ValueError("horizon must be >= 1")
    g = group_cols or []
    keys = [f"k{i}" for i in range(max(len(g), 1))]
    named = [F.col(c).alias(k) for c, k in zip(g, keys)] if g else [F.lit(0).alias("k0")]
    hist = (ts.select(*named, F.col("ds").cast("date").alias("ds"), F.col("y").cast("double").alias("y"))
            .where(F.col("ds").isNotNull() & F.col("y").isNotNull()).groupBy(*keys, "ds").agg(F.avg("y").alias("y")))
    if not g and hist.limit(2).count() < 2:
        raise ValueError("seasonal forecast needs at least 2 monthly observations")
    measures = ["yhat", "yhat_lower", "yhat_upper", "mae"]

    def solve(table: pa.Table) -> pa.Table:
        got = _seasonal_fit(table.column("ds").to_numpy().astype("datetime64[D]"), table.column("y").to_numpy(),
                            horizon, interval)
        n = len(got[0]) if got else 0
        columns = {k: pa.array([table.column(k)[0].as_py()] * n, table.schema.field(k).type) for k in keys}
        columns["ds"] = pa.array(got[0] if got else np.zeros(0, "datetime64[D]"), pa.date32())
        for i, m in enumerate(measures):
            columns[m] = pa.array(got[i + 1] if got else [], pa.float64())
        return pa.table(columns)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in hist.schema.fields if f.name in keys)
    out = hist.groupBy(*keys).applyInArrow(
        solve, f"{kinds}, ds date, " + ", ".join(f"{m} double" for m in measures))
    return out.select(*[F.col(k).alias(c) for c, k in zip(g, keys)], "ds", *measures)
