"""Population drift: quantile edges, histograms, PSI, two-sample KS, percentiles,
feature and score drift with severities (M-1..M-6, A-12, P-15).

All features are handled in one long-format job: both frames are unpivoted to
``(feature, value, rc, cc)`` (``rc`` / ``cc``: rows of the reference / the current side) and every
statistic is a group-by on ``feature``. Three small aggregations (range ends by sketch, range totals,
histograms) read the inputs and combine map-side; one pass shuffles distinct values, partitioned by
``(feature, range)``, and yields the KS distance and all exact quantiles together. So a feature with
billions of distinct values is never held by one task, and nothing is materialised on the way.
Edges are ``#features × (bins + 1)`` values; range tables ``#features × ranges`` rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .ranking import _bucket_count, attach, exact_quantiles, with_range

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for the same results.
# ---------------------------------------------------------------------------
PSI_WARN = 0.10
PSI_ALERT = 0.25
KS_ALPHA = 0.05
KS_STAT_ALERT = 0.30
PSI_EPS = 1e-8
DEFAULT_BINS = 10
REPORT_PERCENTILES = [10, 25, 50, 75, 90]
KEY_NUMERIC_FEATURES = ["credit_score", "orig_ltv", "orig_dti", "orig_upb",
                        "orig_interest_rate", "orig_cltv"]
KS_SERIES_TERMS = 100
EXACT_KS_ROWS = 10_000     # up to this many rows on either side the p-value is exact


def long_format(df: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, value)`` rows for the listed columns, NULL and NaN dropped."""
    cols = [F.col(f).cast("double").alias(f) for f in features]
    long = df.select(*cols).unpivot([], features, "feature", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def two_sides(reference: DataFrame, current: DataFrame | None, features: list[str]) -> DataFrame:
    """``(feature, value, rc, cc)`` of both frames."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    rows = long_format(reference, features).withColumns({"rc": one, "cc": none})
    if current is None:
        return rows
    return rows.unionByName(long_format(current, features).withColumns({"rc": none, "cc": one}))


def feature_names(spark, features: list[str]) -> DataFrame:
    """One row per requested feature (a parameter list), values or not."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))


def profile(long: DataFrame, ref_probs: list[float], cur_probs: list[float] = ()) -> DataFrame:
    """``(feature, n_ref, n_cur, ks_statistic, ref_0, ref_1, …, cur_0, …)`` per feature that has values: counts, the
    largest gap of the two distribution functions, and exact quantiles (linear interpolation) of both sides. All
    columns are of fixed width, so that later aggregations may carry them in hash tables."""
    nb = _bucket_count(long.sparkSession)
    ends = F.percentile_approx("value", [i / nb for i in range(1, nb)], max(10_000, 2 * nb))
    stats = long.groupBy("feature").agg(ends.alias("_ends"), F.sum("rc").alias("n_ref"), F.sum("cc").alias("n_cur"))
    ranged = with_range(long.join(F.broadcast(stats.select("feature", "_ends")), "feature"), "value", "_ends", nb - 1,
                        False, "_range").drop("_ends")
    # One exchange of distinct values serves the range totals and the running sums.
    values = ranged.groupBy("feature", "_range", "value").agg(F.sum("rc").alias("rc"), F.sum("cc").alias("cc"))
    totals = values.groupBy("feature", "_range").agg(F.sum("rc").alias("_tr"), F.sum("cc").alias("_tc"))
    earlier = Window.partitionBy("feature").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("feature", "_range", *[
        F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(o) for t, o in (("_tr", "_or"), ("_tc", "_oc"))])
    upto = Window.partitionBy("feature", "_range").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cum = values.select("*", F.sum("rc").over(upto).alias("_cr"), F.sum("cc").over(upto).alias("_cc"))
    cum = cum.join(F.broadcast(offsets), ["feature", "_range"]).join(F.broadcast(stats.drop("_ends")), "feature")
    cum = cum.withColumns({"_cr": F.col("_cr") + F.col("_or"), "_cc": F.col("_cc") + F.col("_oc")})
    aggs, picks = ["max(abs(try_divide(_cr, n_ref) - try_divide(_cc, n_cur))) AS ks_statistic"], []
    for side, probs, n, c, total in (("ref", ref_probs, "rc", "_cr", "n_ref"), ("cur", cur_probs, "cc", "_cc", "n_cur")):
        for i, p in enumerate(probs):
            at = f"{float(p)!r}D * ({total} - 1)"
            for end, rank in (("lo", f"floor({at})"), ("hi", f"ceil({at})")):
                aggs.append(f"max(CASE WHEN {n} > 0 AND {c} - {n} <= {rank} AND {rank} < {c} THEN value END) AS _{side}{i}{end}")
            picks.append(f"_{side}{i}lo + ({at} - floor({at})) * (_{side}{i}hi - _{side}{i}lo) AS {side}_{i}")
    out = cum.groupBy("feature", "n_ref", "n_cur").agg(*[F.expr(x) for x in aggs])
    return out.selectExpr("feature", "n_ref", "n_cur", "ks_statistic", *picks)


def quantile_columns(side: str, first: int, n: int) -> list[Column]:
    return [F.col(f"{side}_{i}") for i in range(first, first + n)]


def edges_of(quantiles: list[Column]) -> Column:
    """Sorted, distinct bin edges; empty where there is no reference value."""
    return F.array_distinct(F.array_sort(F.array_compact(F.array(*quantiles))))


def bin_probs(n_bins: int) -> list[float]:
    return [i / n_bins for i in range(n_bins + 1)]


def quantile_edges(reference: DataFrame, features: list[str], n_bins: int = DEFAULT_BINS) -> DataFrame:
    """M-1: ``(feature, edges ARRAY<DOUBLE>)`` — reference quantiles at 0, 1/n … 1
    (linear interpolation), sorted and de-duplicated."""
    got = profile(two_sides(reference, None, features), bin_probs(n_bins))
    return got.select("feature", edges_of(quantile_columns("ref", 0, n_bins + 1)).alias("edges"))


def bin_index(v: Column, edges: Column, most: int) -> Column:
    """M-2 bin of ``v`` among at most ``most`` edges: [eᵢ, eᵢ₊₁), the last bin closed; NULL outside."""
    n = F.size(edges)
    raw = -1
    for i in range(most):
        raw = raw + F.coalesce((F.get(edges, F.lit(i)) <= v).cast("int"), F.lit(0))
    inside = (n >= 2) & (v >= F.get(edges, F.lit(0))) & (v <= F.get(edges, n - 1))
    return F.when(inside, F.least(raw, n - 2))


def histogram(long: DataFrame, edges: DataFrame, n_bins: int = DEFAULT_BINS) -> DataFrame:
    """M-2: ``(feature, bin, rn, cn)`` in-range rows of both sides."""
    rows = long.join(F.broadcast(edges.select("feature", "edges")), "feature")
    b = bin_index(F.col("value"), F.col("edges"), n_bins + 1)
    return (rows.select("feature", b.alias("bin"), "rc", "cc").where(F.col("bin").isNotNull())
            .groupBy("feature", "bin").agg(F.sum("rc").alias("rn"), F.sum("cc").alias("cn")))


def _lattice_pvalue(d: float, n: int, m: int) -> float:
    """Two-sided p of D >= d for samples without ties: the share of lattice paths from (0, 0) to (n, m) that
    somewhere leave the band abs(i/n - j/m) < d.

    A random path to (i, j) came from (i - 1, j) with the chance i / (i + j); so the share of paths that have left is
    carried from one anti-diagonal to the next, as a vector over i. Sums of positive terms keep small p exact.
    """
    if n > m:
        n, m = m, n
    unit = np.lcm(n, m)
    h = round(d * float(unit))
    if h <= 0:
        return 1.0
    a, b = int(unit) // n, int(unit) // m
    i = np.arange(n + 1)
    left = np.zeros(n + 1)
    for k in range(1, n + m + 1):
        lo, hi = max(0, k - m), min(n, k)
        at = i[lo:hi + 1]
        came = np.concatenate([[0.0], left])[lo:hi + 1]
        left[lo:hi + 1] = (at * came + (k - at) * left[lo:hi + 1]) / k
        left[lo:hi + 1][np.abs(at * a - (k - at) * b) >= h] = 1.0
    return float(left[n])


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = KS_SERIES_TERMS) -> Column:
    """Two-sided p: exact (lattice paths; one small task-side sum per feature) up to ``EXACT_KS_ROWS`` rows on
    either side; beyond, 2 Σ (−1)^(k−1) exp(−2 k² λ²), λ = D √(nm/(n+m)), 1 below λ = 0.2."""
    ship_package(SparkSession.getActiveSession())
    limit = EXACT_KS_ROWS

    @F.pandas_udf("double")
    def exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        use = (d.notna()) & (n > 0) & (m > 0) & (n <= limit) & (m <= limit)
        return pd.Series([_lattice_pvalue(x, int(y), int(z)) if u else None
                          for x, y, z, u in zip(d, n, m, use)], dtype="float64")
    lam = d * F.sqrt(F.try_divide(n * m, n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam))
    p = F.when(lam < 0.2, F.lit(1.0)).otherwise(2.0 * series)
    p = F.coalesce(exact(d, n, m), p)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def ks_table(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """M-4: ``(feature, ks_statistic, ks_p_value)`` = max |F_ref − F_cur| over all values; 0 and 1 where a side
    has no values."""
    return drift_core(reference, current, features).select("feature", "ks_statistic", "ks_p_value")


def psi_table(reference: DataFrame, current: DataFrame, features: list[str], n_bins: int = DEFAULT_BINS) -> DataFrame:
    """M-3: ``(feature, psi, out_of_range_share)`` per feature.

    0 when either side has no values or there are fewer than two edges; NULL when
    no current value falls inside the reference range (the reference yields NaN).
    """
    return drift_core(reference, current, features, n_bins).select("feature", "psi", "out_of_range_share")


def feature_severity(psi: Column, p: Column) -> Column:
    """P-15 (features): PSI ≥ .25 or p < .05 → alert; PSI ≥ .10 → warning; else ok."""
    return (F.when((F.coalesce(psi, F.lit(0.0)) >= PSI_ALERT) | (p < KS_ALPHA), "alert")
            .when(F.coalesce(psi, F.lit(0.0)) >= PSI_WARN, "warning").otherwise("ok"))


def score_severity(psi: Column, p: Column, d: Column) -> Column:
    """P-15 (scores): PSI ≥ .25 or (p < .05 and D ≥ .30) → alert; PSI ≥ .10 → warning."""
    return (F.when((F.coalesce(psi, F.lit(0.0)) >= PSI_ALERT) | ((p < KS_ALPHA) & (d >= KS_STAT_ALERT)),
                   "alert")
            .when(F.coalesce(psi, F.lit(0.0)) >= PSI_WARN, "warning").otherwise("ok"))


def drift_core(reference: DataFrame, current: DataFrame, features: list[str], n_bins: int = DEFAULT_BINS,
               percentile_probs: list[float] = ()) -> DataFrame:
    """Counts, PSI, KS and (optional) percentiles of both sides for every feature present in both frames."""
    feats = [f for f in features if f in reference.columns and f in current.columns]
    if not feats:
        raise ValueError("no requested feature is present in both frames")
    long = two_sides(reference, current, feats)
    k = n_bins + 1
    got = profile(long, [*bin_probs(n_bins), *percentile_probs], list(percentile_probs))
    keep = [c for c in got.columns if c != "feature"]
    # Rows per last edge that is not above the value (edges may repeat); the profile is read once and its numbers
    # travel along. At most n_bins + 2 rows a feature are left.
    at_most = " + ".join(f"cast(value >= ref_{i} AS int)" for i in range(k))
    rows = long.join(F.broadcast(got), "feature").withColumn(
        "_at", F.expr(f"CASE WHEN value <= ref_{k - 1} THEN nullif({at_most}, 0) END"))
    cells = rows.groupBy("feature", "_at").agg(F.sum("rc").alias("rn"), F.sum("cc").alias("cn"),
                                               *[F.first(c).alias(c) for c in keep])
    cells = cells.withColumn("edges", edges_of(quantile_columns("ref", 0, k)))
    start = F.get(F.array(*quantile_columns("ref", 0, k)), F.col("_at") - 1)
    cells = cells.withColumn("bin", F.when(F.col("_at").isNotNull() & (F.size("edges") >= 2), F.least(
        F.array_position("edges", start).cast("int") - 1, F.size("edges") - 2)))
    cells = cells.groupBy("feature", "bin").agg(F.sum("rn").alias("rn"), F.sum("cn").alias("cn"), F.first("edges").alias(
        "edges"), *[F.first(c).alias(c) for c in keep])
    inside = F.col("bin").isNotNull()
    per = cells.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct(F.coalesce("bin", F.lit(-1)), F.struct("rn", "cn")))).alias("_bins"),
        F.sum(F.when(inside, F.col("rn"))).alias("rt"), F.sum(F.when(inside, F.col("cn"))).alias("ct"),
        F.first("edges").alias("edges"), *[F.first(c).alias(c) for c in keep])

    def share(i: Column, side: str, total: str) -> Column:
        n = F.coalesce(F.try_element_at("_bins", i)[side], F.lit(0))
        return F.greatest(F.try_divide(n, F.col(total)), F.lit(PSI_EPS))
    term = F.transform(F.sequence(F.lit(0), F.greatest(F.size("edges") - 2, F.lit(0))), lambda i: (
        share(i, "cn", "ct") - share(i, "rn", "rt")) * F.ln(share(i, "cn", "ct") / share(i, "rn", "rt")))
    per = per.withColumn("_psi", F.aggregate(term, F.lit(0.0), lambda a, x: a + x))
    out = feature_names(reference.sparkSession, feats).join(per, "feature", "left")
    out = out.fillna(0, ["n_ref", "n_cur", "ct"])
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    psi = (F.when(~both | (F.coalesce(F.size("edges"), F.lit(0)) < 2), F.lit(0.0))
           .when(F.col("ct") == 0, F.lit(None).cast("double")).otherwise(F.col("_psi")))
    oor = F.when(F.col("n_cur") > 0, 1 - F.try_divide(F.col("ct"), F.col("n_cur")))
    p = ks_pvalue(F.col("ks_statistic"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    return out.select("feature", "n_ref", "n_cur", psi.alias("psi"), oor.alias("out_of_range_share"),
                      F.when(both, F.col("ks_statistic")).otherwise(0.0).alias("ks_statistic"),
                      F.when(both, p).otherwise(1.0).alias("ks_p_value"),
                      F.array(*quantile_columns("ref", k, len(percentile_probs))).alias("ref_pct"),
                      F.array(*quantile_columns("cur", 0, len(percentile_probs))).alias("cur_pct"))


def feature_drift(reference: DataFrame, current: DataFrame,
                  features: list[str] | None = None, n_bins: int = DEFAULT_BINS) -> DataFrame:
    """M-5: PSI, KS and severity per feature; features missing from either side skipped."""
    core = drift_core(reference, current, features or KEY_NUMERIC_FEATURES, n_bins)
    sev = feature_severity(F.col("psi"), F.col("ks_p_value"))
    return core.select(
        "feature", F.round("psi", 6).alias("psi"),
        F.round("ks_statistic", 6).alias("ks_statistic"),
        F.round("ks_p_value", 6).alias("ks_p_value"),
        sev.alias("severity"), (sev == "alert").alias("alert"),
        F.col("n_ref").cast("bigint").alias("n_ref"), F.col("n_cur").cast("bigint").alias("n_cur"))


def percentiles(df: DataFrame, value_col: str, group_cols: list[str] | None = None,
                pcts: list[int] | None = None) -> DataFrame:
    """A-12: exact p10/p25/p50/p75/p90 (linear interpolation), rounded to 6, one column each."""
    pcts = pcts or REPORT_PERCENTILES
    g = group_cols or []
    q = exact_quantiles(df, g, value_col, [p / 100 for p in pcts])
    wide = q.groupBy(*[F.col(c) for c in g]).pivot("q_index", list(range(len(pcts)))).agg(
        F.first("value"))
    return wide.select(*[F.col(c) for c in g], *[
        F.round(F.col(str(i)), 6).alias(f"p{p}") for i, p in enumerate(pcts)])


def score_drift(reference: DataFrame, current: DataFrame, score_col: str = "pd",
                n_bins: int = DEFAULT_BINS) -> DataFrame:
    """M-6: one row — PSI, KS, percentiles of both sides, mean shift, severity."""
    core = drift_core(reference, current, [score_col], n_bins, [p / 100 for p in REPORT_PERCENTILES])
    means = attach(reference.agg(F.avg(score_col).alias("rm")),
                   current.agg(F.avg(score_col).alias("cm")))
    sev = score_severity(F.col("psi"), F.col("ks_p_value"), F.col("ks_statistic"))
    out = attach(core, means)

    def pct(side: str) -> list[Column]:
        return [F.round(F.get(f"{side}_pct", F.lit(i)), 6).alias(f"{side}_p{p}") for i, p in enumerate(REPORT_PERCENTILES)]
    return out.select(
        F.round("psi", 6).alias("psi"), F.round("ks_statistic", 6).alias("ks_statistic"),
        F.round("ks_p_value", 6).alias("ks_p_value"),
        *pct("ref"), *pct("cur"),
        F.round(F.col("cm") - F.col("rm"), 6).alias("mean_shift"),
        sev.alias("severity"), (sev == "alert").alias("alert"))
