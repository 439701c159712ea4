"""Cleaning and period parsing (P-1, P-4, P-5, P-7, P-16; traps T1, T3)."""

import datetime as dt

from pyspark.sql import functions as F

from tallyrisk.functions import clean as C


def _one(spark, expr, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("o")).first()["o"]


def test_period_formats_per_row(spark):
    df = spark.createDataFrame([("200301",), ("012023",), ("122011",), ("20030115",), ("2003-01-15",),
                                ("2003-02",), ("junk",), (None,)], "s string")
    got = [r["o"] for r in df.select(C.parse_period(F.col("s")).alias("o")).collect()]
    assert got == [dt.date(2003, 1, 1), dt.date(2023, 1, 1), dt.date(2011, 12, 1), dt.date(2003, 1, 1),
                   dt.date(2003, 1, 1), dt.date(2003, 2, 1), None, None]


def test_tape_period_restores_leading_zero(spark):
    assert _one(spark, C.parse_tape_period(F.col("s")), "12023") == dt.date(2023, 1, 1)
    assert _one(spark, C.parse_tape_period(F.col("s")), "202305") == dt.date(2023, 5, 1)


def test_blank_and_coercion(spark):
    assert _one(spark, C.blank_to_null(F.col("s")), "   ") is None
    assert _one(spark, C.to_double(F.col("s")), "XX") is None
    assert _one(spark, C.to_double(F.col("s")), "NaN") is None
    assert _one(spark, C.to_long(F.col("s")), "720.0") == 720


def test_clip_keeps_null(spark):
    assert _one(spark, C.clip(F.col("s").cast("double"), 1.0, 2.0), None) is None
    assert _one(spark, C.clip(F.col("s").cast("double"), 1.0, 2.0), "5") == 2.0


def test_month_arith(spark):
    assert _one(spark, C.add_months_text(F.col("s"), 3), "112023") == "202402"
