"""Queries: time split, its boundaries and report, stratified split and down-sample
(N-3, W-5, A-13, N-8, N-9) over ``v_score``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import split as SP
from . import bindings as B
from .catalog import query
from .oracle_views import with_views

_CUTS = {
    "mo": "SELECT DISTINCT CAST(period || '-01' AS DATE) AS m FROM v_score WHERE period IS NOT NULL",
    "rk": "SELECT m, row_number() OVER (ORDER BY m) AS pos FROM mo",
    "nm": """SELECT count(*) AS n_months, max(m) AS test_end,
               greatest(1, CAST(round_even(count(*) * 0.6, 0) AS INTEGER)) AS train_cut FROM rk""",
    "cu": """SELECT n_months, test_end, train_cut,
               least(greatest(train_cut + 1, CAST(round_even(n_months * (0.6 + 0.2), 0) AS INTEGER)), n_months - 1) AS val_cut
             FROM nm""",
    "cuts": """SELECT cu.n_months, cu.train_cut, cu.val_cut,
                 (SELECT m FROM rk WHERE pos = cu.train_cut) AS train_end,
                 (SELECT m FROM rk WHERE pos = cu.val_cut) AS val_end, cu.test_end FROM cu""",
    "sp": """SELECT s.id, s.period, s.label,
               CASE WHEN CAST(s.period || '-01' AS DATE) <= c.train_end THEN 'train'
                    WHEN CAST(s.period || '-01' AS DATE) <= c.val_end THEN 'val' ELSE 'test' END AS split
             FROM v_score s, cuts c""",
}


@query("time_split", with_views("SELECT id, period, split FROM sp", "v_score", extra=_CUTS))
def q_time_split(spark, d):
    s = B.scores(spark, d)
    return SP.time_split(s.select("id", "period"), "period")


@query("split_boundaries", with_views(
    "SELECT CAST(n_months AS INTEGER) AS n_months, CAST(train_cut AS INTEGER) AS train_cut, "
    "CAST(val_cut AS INTEGER) AS val_cut, train_end, val_end, test_end FROM cuts", "v_score",
    extra=_CUTS, dates=["train_end", "val_end", "test_end"]))
def q_split_boundaries(spark, d):
    c = SP.split_cuts(B.scores(spark, d), "period")
    return c.select(F.col("n_months").cast("int"), F.col("train_cut").cast("int"),
                    F.col("val_cut").cast("int"), "train_end", "val_end", "test_end")


@query("split_report", with_views("""
SELECT split, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT period) AS BIGINT) AS months,
       max(CAST(period || '-01' AS DATE)) AS last_month, round(avg(CAST(label AS DOUBLE)), 6) AS positive_rate
FROM sp GROUP BY split""", "v_score", extra=_CUTS, dates=["last_month"]))
def q_split_report(spark, d):
    sp = SP.time_split(B.scores(spark, d), "period")
    return SP.split_report(sp, "period", "label")


@query("stratified_split")
def q_stratified_split(spark, d):
    """N-8 (rows only): exact per-class test counts by seeded hash rank."""
    return SP.stratified_split(B.scores(spark, d), "label", "id", 0.2)


@query("stratified_split_counts", with_views("""
SELECT label, unnest(['test', 'train']) AS split, CAST(unnest([t, n - t]) AS BIGINT) AS n
FROM (SELECT label, count(*) AS n, CAST(round_even(count(*) * 0.2, 0) AS BIGINT) AS t FROM v_score GROUP BY label)
""", "v_score"))
def q_stratified_split_counts(spark, d):
    """N-8: rows per class and side; every id is on one side."""
    sp = SP.stratified_split(B.scores(spark, d), "label", "id", 0.2)
    return sp.groupBy("label", "split").agg(F.countDistinct("id").alias("n"))


@query("stratified_downsample_counts", with_views("""
SELECT label, CAST(least(greatest(1, round_even(1000 * n / sum(n) OVER (), 0)), n) AS BIGINT) AS n
FROM (SELECT label, count(*) AS n FROM v_score GROUP BY label)""", "v_score"))
def q_stratified_downsample_counts(spark, d):
    """N-9: rows per class of a sample of 1,000."""
    kept = SP.stratified_downsample(B.scores(spark, d), "label", "id", 1000)
    return kept.groupBy("label").agg(F.countDistinct("id").alias("n"))


@query("stratified_downsample")
def q_stratified_downsample(spark, d):
    """N-9 (rows only): class-proportional sample capped at the reference's 3,000 rows."""
    return SP.stratified_downsample(B.scores(spark, d), "label", "id", 3000)
