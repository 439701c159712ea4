"""Time split, split report, stratified split and stratified down-sampling
(N-3, W-5, A-13, N-8, N-9).

The time split works on the distinct months (bounded by the calendar): the two
cut months are found on that small frame and broadcast back, so the split of
the data is a single projection. The stratified operators rank rows by a
seeded hash within each class using distributed prefix counts, which gives
exact per-class counts without ever sorting a class in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import parse_period, with_period
from .ranking import attach, cumulative

DEFAULT_SEED = 42


def _month(col: str):
    """Month of a DATE, TIMESTAMP or date-like text column (P-5 rules)."""
    return parse_period(F.col(col).cast("string"))


def split_cuts(df: DataFrame, date_col: str, train_ratio: float = 0.6, val_ratio: float = 0.2,
               test_ratio: float = 0.2) -> DataFrame:
    """One row: ``n_months, train_cut, val_cut, train_end, val_end, test_end`` (months as DATE).

    cut₁ = max(1, round(m·train)); cut₂ = min(max(cut₁+1, round(m·(train+val))), m−1), with
    Python's half-even rounding. Fewer than 3 months or ratios not summing to 1 → error.
    """
    if abs(train_ratio + val_ratio + test_ratio - 1.0) > 1e-6:
        raise ValueError("train_ratio + val_ratio + test_ratio must equal 1.0")
    months = df.select(_month(date_col).alias("m")).where(F.col("m").isNotNull()).distinct()
    # Distinct months: calendar-sized, so the global ordering window runs on a tiny frame.
    ranked = months.select("m", F.row_number().over(Window.orderBy("m")).alias("pos"))
    n = ranked.agg(F.count(F.lit(1)).alias("n_months"), F.max("m").alias("test_end"))
    c1 = F.greatest(F.lit(1), F.bround(F.col("n_months") * train_ratio, 0).cast("int"))
    c2 = F.least(F.greatest(c1 + 1, F.bround(F.col("n_months") * (train_ratio + val_ratio), 0)
                            .cast("int")), F.col("n_months") - 1)
    cuts = n.select("n_months", "test_end", c1.alias("train_cut"), c2.alias("val_cut"))
    j = attach(ranked, cuts)
    out = j.groupBy().agg(
        F.max("n_months").alias("n_months"), F.max("train_cut").alias("train_cut"),
        F.max("val_cut").alias("val_cut"),
        F.max(F.when(F.col("pos") == F.col("train_cut"), F.col("m"))).alias("train_end"),
        F.max(F.when(F.col("pos") == F.col("val_cut"), F.col("m"))).alias("val_end"),
        F.max("test_end").alias("test_end"))
    few = F.coalesce(F.col("n_months"), F.lit(0)) < 3
    err = F.raise_error(F.concat(
        F.lit("Need at least 3 distinct months to produce train/val/test splits; found "),
        F.coalesce(F.col("n_months"), F.lit(0)).cast("string")))
    return out.select("n_months", "train_cut", "val_cut",
                      F.when(few, err).otherwise(F.col("train_end")).alias("train_end"),
                      "val_end", "test_end")


def time_split(df: DataFrame, date_col: str, train_ratio: float = 0.6, val_ratio: float = 0.2,
               test_ratio: float = 0.2) -> DataFrame:
    """N-3 / W-5: add ``split`` ∈ {train, val, test} by month ≤ a, a < month ≤ b, month > b."""
    cuts = split_cuts(df, date_col, train_ratio, val_ratio, test_ratio).select("train_end", "val_end")
    j = attach(with_period(df, date_col, "_m"), cuts)
    m = F.col("_m")
    split = (F.when(m <= F.col("train_end"), "train").when(m <= F.col("val_end"), "val")
             .when(m.isNotNull(), "test"))
    return j.select(*[F.col(c) for c in df.columns], split.alias("split"))


def split_report(split_df: DataFrame, date_col: str, label_col: str | None = None) -> DataFrame:
    """A-13: per split rows, distinct months, last month and positive rate."""
    split_df = with_period(split_df, date_col, "_m")
    m = F.col("_m")
    aggs = [F.count(F.lit(1)).cast("bigint").alias("rows"),
            F.count_distinct(m).cast("bigint").alias("months"), F.max(m).alias("last_month")]
    if label_col:
        aggs.append(F.round(F.avg(F.col(label_col).cast("double")), 6).alias("positive_rate"))
    return split_df.groupBy("split").agg(*aggs)


def _below_cut(df: DataFrame, label_col: str, id_col: str, quota: DataFrame, seed: int) -> DataFrame:
    """``df`` with ``_h`` (seeded hash) and ``_in``: among its class's first ``_q`` rows by hash.

    Only the hash at each class's cut is looked up (one row per class, broadcast); rows are not shuffled. A shuffle
    by the class would leave all rows in one task per class.
    """
    keyed = df.withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed)))
    ranks = cumulative(keyed.select(label_col, "_h", F.lit(1).alias("_c")), [label_col], "_h", ["_c"])
    same = ranks[label_col].eqNullSafe(quota[label_col])
    cut = ranks.join(F.broadcast(quota), same).where(F.col("cum__c") <= F.col("_q")).groupBy(
        ranks[label_col].alias("_class")).agg(F.max("_h").alias("_cut"))
    return keyed.join(F.broadcast(cut), keyed[label_col].eqNullSafe(cut["_class"]), "left").withColumn(
        "_in", F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False))).drop("_class", "_cut")


def stratified_split(df: DataFrame, label_col: str, id_col: str, test_size: float = 0.2,
                     seed: int = DEFAULT_SEED) -> DataFrame:
    """N-8: seeded stratified split with exact per-class test counts round(n_c · test_size).

    Membership differs from the reference's random generator by design.
    """
    quota = df.groupBy(label_col).agg(F.bround(F.count(F.lit(1)) * test_size, 0).alias("_q"))
    marked = _below_cut(df, label_col, id_col, quota, seed)
    return marked.select(*[F.col(c) for c in df.columns],
                         F.when(F.col("_in"), "test").otherwise("train").alias("split"))


def stratified_downsample(df: DataFrame, label_col: str, id_col: str, max_rows: int,
                          seed: int = DEFAULT_SEED) -> DataFrame:
    """N-9: per class max(1, round(max_rows · share)) rows by seeded hash order, at most
    ``max_rows`` in total; a single class → plain seeded sample of ``max_rows``."""
    n = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    tot = n.agg(F.sum("_n").alias("_tot"), F.count(F.lit(1)).alias("_k"))
    quota = attach(n, tot).select(
        label_col, F.when(F.col("_k") > 1, F.greatest(F.lit(1), F.bround(
            F.lit(max_rows) * F.col("_n") / F.col("_tot"), 0))).otherwise(F.lit(max_rows))
        .alias("_q"))
    kept = _below_cut(df, label_col, id_col, quota, seed).where("_in")
    # The quotas sum to about max_rows, so the overall limit orders a bounded number of rows.
    return kept.orderBy("_h", id_col).limit(max_rows).select(*[F.col(c) for c in df.columns])
