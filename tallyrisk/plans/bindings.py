"""Bindings of the driver's tables to loan-portfolio frames.

All derivations are deterministic integer arithmetic on keys and dates so the
DuckDB oracle (``oracle_views.py``) can rebuild the very same rows. Every
frame is lazy; nothing is collected, and the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import coerce_types, normalize_blanks, to_long, with_period

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Column order of the synthetic origination tape (a subset of the 32-column layout).
ORIG_TAPE_COLUMNS = [
    "credit_score", "first_payment_date", "first_time_homebuyer_flag", "maturity_date",
    "mi_pct", "num_units", "occupancy_status", "orig_cltv", "orig_dti", "orig_upb", "orig_ltv",
    "orig_interest_rate", "channel", "ppm_flag", "amortization_type", "property_state",
    "property_type", "loan_sequence_number", "loan_purpose", "orig_loan_term", "num_borrowers",
    "super_conforming_flag", "io_indicator",
]
ORIG_TYPES = {
    "credit_score": "double", "mi_pct": "double", "orig_cltv": "double", "orig_dti": "double",
    "orig_upb": "double", "orig_ltv": "double", "orig_interest_rate": "double",
    "num_units": "long", "orig_loan_term": "long", "num_borrowers": "long",
}
PERF_TAPE_COLUMNS = [
    "loan_sequence_number", "monthly_reporting_period", "current_actual_upb",
    "current_delinquency_status", "loan_age", "remaining_months_to_legal_maturity",
    "modification_flag", "zero_balance_code", "current_interest_rate",
]
PERF_TYPES = {
    "current_actual_upb": "double", "loan_age": "long",
    "remaining_months_to_legal_maturity": "long", "current_interest_rate": "double",
}
DRIFT_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "price_shifted"]
DRIFT_CUTOFF = "1998-07-01"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _loan_seq(k: Column) -> Column:
    return F.concat(F.lit("L"), F.lpad(_s(k), 10, "0"))


def _rate_text(whole: Column, tenth: Column) -> Column:
    return F.concat(_s(whole), F.lit("."), _s(tenth))


def orig_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw origination tape: all strings, blanks and junk values included."""
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    k = F.col("o_orderkey")
    od = F.col("o_orderdate")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    cols = {
        "credit_score": F.when(k % 97 == 0, F.lit(" ")).when(k % 89 == 0, F.lit("XX"))
        .otherwise(_s(280 + (k * 7919) % 600)),
        "first_payment_date": F.when(k % 2 == 0, F.date_format(od, "yyyyMM"))
        .otherwise(F.date_format(od, "MMyyyy")),
        "first_time_homebuyer_flag": F.when(k % 3 == 0, "Y").when(k % 3 == 1, "N").otherwise(" "),
        "maturity_date": F.date_format(F.add_months(od.cast("date"), 360), "yyyyMM"),
        "mi_pct": F.when(k % 4 == 0, _s(k % 35)).otherwise(F.lit("")),
        "num_units": _s(1 + k % 4),
        "occupancy_status": F.when(F.col("o_orderstatus") == "F", "P")
        .when(F.col("o_orderstatus") == "O", "I").otherwise("S"),
        "orig_cltv": _s(40 + (k * 31) % 80 + k % 5),
        "orig_dti": F.when(k % 59 == 0, F.lit("")).otherwise(_s(k % 71)),
        "orig_upb": _s(F.floor(F.col("o_totalprice") * 2).cast("bigint")),
        "orig_ltv": _s(40 + (k * 31) % 80),
        "orig_interest_rate": _rate_text(2 + F.expr("(o_orderkey % 80) div 10"), k % 10),
        "channel": F.when(F.substring("o_orderpriority", 1, 1) == "1", "R")
        .when(F.substring("o_orderpriority", 1, 1) == "2", "B")
        .when(F.substring("o_orderpriority", 1, 1) == "3", "C")
        .when(F.substring("o_orderpriority", 1, 1) == "4", "T").otherwise("9"),
        "ppm_flag": F.when(k % 11 == 0, "Y").otherwise("N"),
        "amortization_type": F.when(k % 53 == 0, " arm").when(k % 7 == 0, "ARM").otherwise("FRM"),
        "property_state": F.concat(F.lit("S"), _s(F.col("c_nationkey"))),
        "property_type": F.when(F.col("c_mktsegment") == "AUTOMOBILE", "SF")
        .when(F.col("c_mktsegment") == "BUILDING", "PU")
        .when(F.col("c_mktsegment") == "FURNITURE", "CO")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "MH")
        .when(F.col("c_mktsegment") == "MACHINERY", "CP").otherwise(""),
        "loan_sequence_number": _loan_seq(k),
        "loan_purpose": F.when(k % 5 == 0, "P").when(k % 5 == 1, "C").when(k % 5 == 2, "N")
        .when(k % 5 == 3, "R").otherwise("9"),
        "orig_loan_term": F.when(k % 4 == 0, "180").otherwise("360"),
        "num_borrowers": _s(1 + k % 2),
        "super_conforming_flag": F.when(k % 13 == 0, "Y").otherwise(" "),
        "io_indicator": F.lit("N"),
    }
    quarter = F.concat(_s(F.year(od)), F.lit("Q"), _s(F.quarter(od)))
    return j.select(k.alias("loan_id"), *[cols[n].alias(n) for n in ORIG_TAPE_COLUMNS],
                    quarter.alias("quarter"))


def orig(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed origination: blanks → NULL, numbers coerced, period parsed."""
    t = coerce_types(normalize_blanks(orig_tape(spark, sf_dir)), ORIG_TYPES)
    return with_period(t, "first_payment_date", "first_payment_month")


def perf_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw performance tape: one row per (order, ship month) of lineitem."""
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    m = F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("m")
    agg = (li.groupBy(F.col("l_orderkey"), m)
           .agg(F.min("l_extendedprice").alias("min_price"),
                F.max(F.col("l_quantity").cast("bigint") % 5).alias("status"),
                F.max("l_returnflag").alias("max_flag")))
    j = agg.join(o, agg.l_orderkey == o.o_orderkey, "left")
    k = F.col("l_orderkey")
    age = ((F.year("m") - F.year("o_orderdate")) * 12 + F.month("m") - F.month("o_orderdate"))
    zb = (k + F.month("m")) % 23
    cols = {
        "loan_sequence_number": _loan_seq(k),
        "monthly_reporting_period": F.date_format("m", "MMyyyy"),
        "current_actual_upb": _s(F.floor("min_price").cast("bigint")),
        "current_delinquency_status": F.when(k % 41 == 0, F.lit("XX")).otherwise(_s(F.col("status"))),
        "loan_age": _s(age),
        "remaining_months_to_legal_maturity": _s(360 - age),
        "modification_flag": F.when(F.col("max_flag") == "R", "Y").otherwise("N"),
        "zero_balance_code": F.when(zb == 0, "02").when(zb == 1, "03").when(zb == 2, "06")
        .when(zb == 3, "09").when(zb == 4, "15").when(zb == 5, "01"),
        "current_interest_rate": _rate_text(2 + F.expr("(l_orderkey % 80) div 10"),
                                            (k + F.month("m")) % 10),
    }
    return j.select(k.alias("loan_id"), *[cols[n].alias(n) for n in PERF_TAPE_COLUMNS])


def perf(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = coerce_types(normalize_blanks(perf_tape(spark, sf_dir)), PERF_TYPES)
    return with_period(t, "monthly_reporting_period", "reporting_month")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan-month panel ``(loan_id, reporting_month DATE, dpd INT)``."""
    p = perf(spark, sf_dir)
    return p.select("loan_id", "reporting_month",
                    (to_long(F.col("current_delinquency_status")) * 30).cast("int").alias("dpd"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored population ``(id, pd, label, period)``; pd has ties by construction."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        (((k * 7919) % 1000) / 1000.0).alias("pd"),
        F.when((k * 104729) % 1000 < (k * 7919) % 1000, 1).otherwise(0).alias("label"),
        F.date_format("o_orderdate", "yyyy-MM").alias("period"),
    )


def drift_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference (before the cutoff) and current (from it) lineitem samples."""
    li = read(spark, sf_dir, "lineitem")
    before = F.col("l_shipdate") < F.lit(DRIFT_CUTOFF).cast("timestamp_ntz")
    base = ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount"]
    ref = li.filter(before).select(*base, F.col("l_extendedprice").alias("price_shifted"))
    cur = li.filter(~before).select(*base, (F.col("l_extendedprice") * 1.3).alias("price_shifted"))
    return ref, cur


def series_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five daily series ``(series_id, date, value)``: mean order price per priority."""
    o = read(spark, sf_dir, "orders")
    p = F.substring("o_orderpriority", 1, 1)
    sid = (F.when(p == "1", "urgent").when(p == "2", "high").when(p == "3", "medium")
           .when(p == "4", "not_specified").otherwise("low"))
    return (o.groupBy(sid.alias("series_id"), F.col("o_orderdate").cast("date").alias("date"))
            .agg(F.avg("o_totalprice").alias("value")))


def series_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same series observed only on quarter starts (input of the ffill resample)."""
    s = series_daily(spark, sf_dir)
    return s.filter((F.dayofmonth("date") == 1) & F.month("date").isin(1, 4, 7, 10))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events")
