"""Macro resampling and join (P-9, J-3, J-4), time split golden case (N-3), trend forecast (L-11/12)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyrisk.operators import forecast as FC
from tallyrisk.operators import macro as MC
from tallyrisk.operators import split as SP


def test_quarterly_ffill_gives_ten_months(spark):
    obs = spark.createDataFrame([("g", dt.date(2020, m, 1), float(100 + i))
                                 for i, m in enumerate([1, 4, 7, 10])], "series_id string, date date, value double")
    out = MC.resample_monthly(obs, "ffill").orderBy("month").collect()
    assert len(out) == 10
    assert [r["value"] for r in out[:4]] == [100.0, 100.0, 100.0, 101.0]


def test_weekly_mean_has_no_empty_month(spark):
    obs = spark.createDataFrame([("w", dt.date(2020, 1, 6) + dt.timedelta(days=7 * i), float(i))
                                 for i in range(8)], "series_id string, date date, value double")
    out = MC.resample_monthly(obs, "mean").collect()
    assert all(r["value"] is not None for r in out)
    with pytest.raises(ValueError):
        MC.resample_monthly(obs, "median")


def test_macro_join_values_and_errors(spark):
    macro = spark.createDataFrame([(f"2020-0{m}", v) for m, v in zip(range(1, 7), [1.5, 1.5, .25, .25, .25, .1])],
                                  "period string, fed_funds_rate double")
    loans = spark.createDataFrame([(1, "202001"), (2, "202004"), (3, "199901")],
                                  "loan_id int, first_payment_date string")
    out = {r["loan_id"]: r["fed_funds_rate"] for r in MC.macro_join(loans, macro, "first_payment_date").collect()}
    assert out == {1: 1.5, 2: 0.25, 3: None}
    with pytest.raises(KeyError):
        MC.macro_join(loans, macro, "no_such_column")


def test_time_split_golden_case(spark):
    days = [(dt.date(2022, 1, 1) + dt.timedelta(days=i),) for i in range(730)]
    df = spark.createDataFrame(days, "date date")
    cuts = SP.split_cuts(df, "date").first()
    assert (str(cuts["train_end"]), str(cuts["val_end"]), str(cuts["test_end"])) == (
        "2023-02-01", "2023-07-01", "2023-12-01")
    sizes = {r["split"]: r["count"] for r in SP.time_split(df, "date").groupBy("split").count().collect()}
    assert sizes == {"train": 424, "val": 153, "test": 153}


def test_time_split_needs_three_months(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1),), (dt.date(2022, 2, 1),)], "date date")
    with pytest.raises(Exception):
        SP.split_cuts(df, "date").collect()
    with pytest.raises(ValueError):
        SP.split_cuts(df, "date", 0.5, 0.5, 0.5)


def test_trend_fit_and_forecast(spark):
    ts = spark.createDataFrame([(dt.date(2024, m, 1), y) for m, y in [(1, .02), (2, .025), (3, .03)]],
                               "ds date, y double")
    fit = FC.trend_fit(ts)
    f = fit.first()
    assert abs(f["slope"] - 0.005) < 1e-9 and abs(f["intercept"] - 0.02) < 1e-9 and f["band"] == 0.01
    fc = FC.trend_forecast(FC.future_months(fit, 4), fit).orderBy("ds").collect()
    assert [round(r["yhat"], 6) for r in fc] == [0.035, 0.04, 0.045, 0.05]
    assert all(0 <= r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"] <= 1 for r in fc)
