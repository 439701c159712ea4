"""Quantile profiles that merge (A-12, M-1, M-3, opt-in): one KLL sketch per period and feature.

The exact statistics of ``drift`` read both sides' rows whenever they are asked for. A profile is read from the
rows once, kept as a table of a few kilobytes per (period, feature), and answers from then on: profiles of
periods merge into the profile of any set of them, and percentiles and PSI come from the merged sketches.

A quantile's rank is off by at most ``rank_error(k)`` of the rows with 99 % confidence; a profile of fewer
values than ``k`` is exact. Sketches compact by random halves, so reruns agree within the bound, not to the
last digit. Nulls and NaNs are left out; a period without values has no row for the feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .drift import DEFAULT_BINS, PSI_EPS, REPORT_PERCENTILES

SKETCH_K = 4096
GRID = 1000    # ranks at which PSI reads a sketch: half a step more of rank error


def rank_error(k: int = SKETCH_K) -> float:
    """Published bound of KLL sketches for both sides of a rank, as a share of the rows."""
    return 2.446 / k ** 0.9433


def sketch_profile(df: DataFrame, features: list[str], period: Column | None = None, k: int = SKETCH_K) -> DataFrame:
    """period, feature, n, sketch: all features in one pass, partial sketches merged before the shuffle's end."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    long = df.select((F.lit("all") if period is None else period.cast("string")).alias("period"), F.inline(pairs))
    return long.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("period", "feature").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def merged(profile: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """feature, n, sketch: the periods of a profile (or of the rows a filter leaves of it) as one."""
    return profile.groupBy("feature").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_percentiles(profile: DataFrame, pcts: list[int] | None = None, k: int = SKETCH_K) -> DataFrame:
    """feature, n and one column per percentile: the item at that rank, without interpolation."""
    return merged(profile, k).select("feature", "n", *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(p / 100)).alias(f"p{p}") for p in pcts or REPORT_PERCENTILES])


def sketch_psi(reference: DataFrame, current: DataFrame, n_bins: int = DEFAULT_BINS, k: int = SKETCH_K) -> DataFrame:
    """feature, n_ref, n_cur, psi of two profiles, from their sketches alone.

    Bins end at the reference's quantiles and hold the values up to and including their end, the last one all
    above the one before; so PSI is near ``psi_table``'s for continuous features and may differ where many values
    tie at an edge. A feature on one side only has no row.
    """
    grid = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)]))
    inner = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / n_bins) for i in range(1, n_bins)]))
    ref = merged(reference, k).select("feature", F.col("n").alias("n_ref"), grid.alias("ref"),
                                      F.array_distinct(inner).alias("edges"))
    cur = merged(current, k).select("feature", F.col("n").alias("n_cur"), grid.alias("cur"))
    both = ref.join(cur, "feature")

    def shares(side: str) -> Column:
        upto = F.transform("edges", lambda e: F.size(F.filter(side, lambda v: v <= e)) / F.lit(float(GRID)))
        upto = F.concat(F.array(F.lit(0.0)), upto, F.array(F.lit(1.0)))
        return F.transform(F.slice(upto, 2, F.size(upto) - 1), lambda r, i: F.greatest(
            r - F.get(upto, i), F.lit(PSI_EPS)))
    terms = F.zip_with(shares("cur"), shares("ref"), lambda c, r: (c - r) * F.log(c / r))
    return both.select("feature", "n_ref", "n_cur",
                       F.aggregate(terms, F.lit(0.0), lambda a, t: a + t).alias("psi"))
