"""Forward default label (J-1): cases derived from horizon, threshold and offsets."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyrisk.operators.labels import (default_label, forward_default_label,
                                        forward_default_label_naive, label_balance)

from .conftest import SF_SMALL

START = dt.date(2019, 11, 1)


def month(offset):
    at = START.year * 12 + START.month - 1 + offset
    return dt.date(at // 12, at % 12 + 1, 1)


def panel(spark, histories, names=("loan_id", "reporting_month", "dpd")):
    """histories: loan -> [(month offset, days past due)]."""
    rows = [(loan, month(k), dpd) for loan, seen in histories.items() for k, dpd in seen]
    return spark.createDataFrame(rows, f"{names[0]} string, {names[1]} date, {names[2]} int")


def expected(histories, horizon, threshold):
    """1 where the row is bad or a bad row follows within ``horizon`` months; by definition."""
    out = []
    for loan, seen in histories.items():
        bad = {k for k, dpd in seen if dpd >= threshold}
        out += [(loan, month(k), int(any(k < b <= k + horizon for b in bad))) for k, _ in seen]
    return sorted(out)


def labels(df, **kw):
    loan, when = kw.get("loan_col", "loan_id"), kw.get("date_col", "reporting_month")
    return sorted((r[loan], r[when], r["label"]) for r in forward_default_label(df, **kw).collect())


@pytest.mark.parametrize("horizon", [1, 6, 12])
@pytest.mark.parametrize("threshold", [30, 60])
def test_event_at_every_distance(spark, horizon, threshold):
    """One loan per distance of its only later row, just at and just under the threshold."""
    histories = {f"{kind}{gap}": [(0, 0), (gap, threshold - (kind == "near"))]
                 for gap in range(1, horizon + 3) for kind in ("at", "near")}
    got = labels(panel(spark, histories), horizon=horizon, threshold=threshold)
    assert got == expected(histories, horizon, threshold)
    firsts = {loan: y for loan, when, y in got if when == START}
    assert {loan for loan, y in firsts.items() if y} == {f"at{g}" for g in range(1, horizon + 1)}


def test_events_that_do_not_count(spark):
    histories = {"same-month": [(5, 200)], "earlier": [(0, 200), (4, 0)], "other-loan": [(3, 0)], "none": []}
    assert [y for *_, y in labels(panel(spark, histories))] == [0] * 4


def test_random_histories(spark):
    rng = random.Random(11)
    histories = {f"loan{i}": [(k, rng.choice((0, 0, 0, 29, 59, 60, 120))) for k in
                              sorted(rng.sample(range(40), rng.randint(1, 25)))] for i in range(25)}
    frame = panel(spark, histories)
    assert labels(frame) == expected(histories, 12, 60)
    assert labels(frame, horizon=3, threshold=120) == expected(histories, 3, 120)


def test_repeated_rows_stay(spark):
    seen = [(2, 0)] * 3 + [(9, 75)] * 2
    got = labels(panel(spark, {"twice": seen}))
    assert [y for *_, y in got] == [1, 1, 1, 0, 0]


def test_other_column_names(spark):
    names = ("account", "as_of", "arrears")
    frame = panel(spark, {"a": [(0, 0), (2, 61)]}, names)
    out = forward_default_label(frame, loan_col="account", date_col="as_of", dpd_col="arrears")
    assert dict(out.dtypes)["label"] == "int"
    assert [r["label"] for r in out.orderBy("as_of").collect()] == [1, 0]


def test_naive_twin_agrees_on_driver_tables(spark):
    from tallyrisk.plans.bindings import panel as loan_panel

    p = loan_panel(spark, SF_SMALL)
    a = forward_default_label(p).groupBy("label").count().orderBy("label").collect()
    b = forward_default_label_naive(p).groupBy("label").count().orderBy("label").collect()
    assert a == b


def test_balance_and_row_label(spark):
    flags = [i % 3 == 0 for i in range(12)]
    r = label_balance(spark.createDataFrame([(int(x),) for x in flags], "label int")).first()
    assert (r["positives"], r["total"]) == (sum(flags), len(flags))
    assert r["percent"] == pytest.approx(100 * sum(flags) / len(flags), abs=0.01)
    codes = spark.createDataFrame([("09",), ("06",), ("16",), (None,)], "zero_balance_code string")
    assert [x[0] for x in codes.select(default_label(codes)).collect()] == [1, 1, 0, 0]
    with pytest.raises(ValueError):
        default_label(codes.select(F.lit(1).alias("unrelated")))
