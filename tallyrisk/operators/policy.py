"""Credit decisions and policy evaluation (P-12..P-14, N-2, N-7, A-3..A-7).

Policies are parameter rows. Rows are collapsed to distinct PDs with their counts before
a literal array of policy structs is exploded over them (a bounded ×P fan-out, no join),
so one job caps and summarises all policies; single rows are decided only where they are asked for.

The review capacity (N-2) keeps the ``max(1, floor(n·cap))`` highest-PD rows
of the review band (ties: smaller id first) and demotes the rest to approve.
It needs a global rank; it is computed with distributed prefix counts: first
over distinct PD values (descending) to find the cut value, then over ids
inside the one PD value tied at the cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import attach, cumulative

APPROVE, REVIEW, DECLINE = "approve", "review", "decline"


@dataclass(frozen=True)
class Policy:
    name: str
    approve: float
    decline: float
    capacity: float | None = None

    def __post_init__(self):
        if not (0 < self.approve < self.decline < 1):
            raise ValueError("thresholds must satisfy 0 < approve < decline < 1")
        if self.capacity is not None and not (0 < self.capacity <= 1):
            raise ValueError("review capacity must be in (0, 1]")


# ---------------------------------------------------------------------------
# The reference's three comparison policies and LGD.
# ---------------------------------------------------------------------------
DEFAULT_POLICIES = [
    Policy("strict", 0.05, 0.15, 0.05),
    Policy("balanced", 0.10, 0.25, 0.10),
    Policy("lenient", 0.20, 0.40, 0.15),
]
DEFAULT_LGD = 0.6
RISK_TIERS = [("Low", 0.25), ("Moderate", 0.5), ("High", 0.75), ("Very High", None)]


def decide(pd_col: Column, approve: Column | float, decline: Column | float) -> Column:
    """P-12: pd < approve → approve; pd ≥ decline → decline; else review."""
    a = approve if isinstance(approve, Column) else F.lit(approve)
    d = decline if isinstance(decline, Column) else F.lit(decline)
    return F.when(pd_col < a, APPROVE).when(pd_col >= d, DECLINE).otherwise(REVIEW)


def score_decision(pd_col: Column, threshold: Column | float = 0.5) -> Column:
    """P-13: pd ≥ threshold → 'default' else 'current' (threshold may be per record)."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.when(pd_col >= t, "default").otherwise("current")


def risk_tier(pd_col: Column) -> Column:
    """P-14: <.25 Low, <.5 Moderate, <.75 High, else Very High."""
    expr = None
    for name, upper in RISK_TIERS:
        if upper is None:
            return expr.otherwise(name)
        expr = F.when(pd_col < upper, name) if expr is None else expr.when(pd_col < upper, name)
    return expr


def _policy_array(policies: list[Policy]) -> Column:
    return F.array(*[
        F.struct(F.lit(i).alias("policy_order"), F.lit(p.name).alias("policy"),
                 F.lit(p.approve).alias("approve"), F.lit(p.decline).alias("decline"),
                 F.lit(p.capacity).cast("double").alias("capacity"))
        for i, p in enumerate(policies)])


def _policy_rows(df: DataFrame, policies: list[Policy]) -> DataFrame:
    """Every row under every policy, with the uncapped decision ``raw``."""
    each = df.select("*", F.inline(_policy_array(policies)))
    return each.withColumn("raw", decide(F.col("pd"), F.col("approve"), F.col("decline")))


def _totals(counted: DataFrame) -> DataFrame:
    """Per policy the review band's rows and the rows it may keep, from distinct PDs with their counts ``n``."""
    tot = counted.groupBy("policy").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("raw") == REVIEW, F.col("n"))).alias("n_review"),
        F.max("capacity").alias("cap"))
    return tot.where("cap IS NOT NULL").select("policy", "n_review", F.greatest(
        F.lit(1), F.floor(F.col("n") * F.col("cap"))).cast("long").alias("max_review")).where("n_review > max_review")


def _cuts(counted: DataFrame, policies: list[Policy]) -> DataFrame:
    """Policies whose review band exceeds its capacity: ``cut_pd``, the first PD (from the highest) that does
    not fit whole, and ``k_at_cut``, how many of its rows do. One row per policy."""
    band = counted.where(F.col("raw") == REVIEW).join(F.broadcast(_totals(counted)), "policy")
    prefix = cumulative(band.select("policy", "max_review", "pd", "n"), ["policy", "max_review"], "pd", ["n"],
                        descending=True, max_groups=len(policies))
    return prefix.where(F.col("cum_n") > F.col("max_review")).groupBy("policy").agg(
        F.max("pd").alias("cut_pd"),
        F.max_by(F.col("max_review") - (F.col("cum_n") - F.col("n")), F.col("pd")).alias("k_at_cut"))


def _cut_ids(scores: DataFrame, cuts: DataFrame, n_policies: int, sums: list[str]) -> DataFrame:
    """``cuts`` with ``kept``: the last id kept of the rows tied at the cut (ids break the tie) and the number
    and ``sums`` of the rows up to it; NULL when none of them fits. One row per policy."""
    tied = scores.join(F.broadcast(cuts), F.col("pd") == F.col("cut_pd"))
    group = ["policy", "cut_pd", "k_at_cut"]
    ids = cumulative(tied.select(*group, "id", F.lit(1).alias("n"), *sums), group, "id", ["n", *sums],
                     max_groups=n_policies)
    fits = (F.col("k_at_cut") > 0) & (F.col("cum_n") >= F.col("k_at_cut"))
    return ids.groupBy(*group).agg(F.min(F.when(fits, F.struct(
        "id", F.col("cum_n").alias("n"), *[F.col("cum_" + c).alias(c) for c in sums]))).alias("kept"))


def decide_with_capacity(scores: DataFrame, policies: list[Policy], id_col: str = "id",
                         pd_col: str = "pd", extra_cols: list[str] | None = None) -> DataFrame:
    """N-2 for every policy: ``(policy, policy_order, id, pd, …, decision)``.

    The cuts come from distinct PDs with their counts; rows meet the policies only in the last
    projection, against the broadcast cuts (a row per policy), and are never shuffled.
    """
    extra = extra_cols or []
    base = scores.select(F.col(id_col).alias("id"), F.col(pd_col).alias("pd"), *extra)
    counted = _policy_rows(base.groupBy("pd").agg(F.count(F.lit(1)).alias("n")), policies)
    cuts = _cut_ids(base, _cuts(counted, policies), len(policies), []).withColumn("cut_id", F.col("kept.id"))
    out = _policy_rows(base, policies).join(F.broadcast(cuts), "policy", "left")
    tie_demoted = (F.col("pd") == F.col("cut_pd")) & (
        F.col("cut_id").isNull() | (F.col("id") > F.col("cut_id")))
    demote = (F.col("raw") == REVIEW) & F.col("cut_pd").isNotNull() & (
        (F.col("pd") < F.col("cut_pd")) | tie_demoted)
    return out.select("policy", "policy_order", "id", "pd", *extra,
                      F.when(demote, APPROVE).otherwise(F.col("raw")).alias("decision"))


def _rates(counts: DataFrame, lgd: float) -> DataFrame:
    """A-3's columns from per-policy counts, the approved rows' PD sum and the approved rows' label rate."""
    n = F.col("n_total")
    return counts.select(
        "policy", "policy_order", "n_total", "n_approved", "n_review", "n_declined",
        F.round(F.try_divide(F.col("n_approved"), n), 6).alias("approval_rate"),
        F.round(F.try_divide(F.col("n_review"), n), 6).alias("review_rate"),
        F.round(F.try_divide(F.col("n_declined"), n), 6).alias("decline_rate"),
        F.round(F.coalesce(F.try_divide(F.col("_sum_pd"), F.col("n_approved")), F.lit(0.0)), 6)
        .alias("mean_pd_approved"),
        F.round(F.coalesce(F.try_divide(F.col("_sum_pd") * lgd, n), F.lit(0.0)), 6)
        .alias("expected_loss_rate"),
        F.round("_adr", 6).alias("actual_default_rate_approved"))


def policy_metrics(decided: DataFrame, lgd: float = DEFAULT_LGD,
                   label_col: str | None = "label") -> DataFrame:
    """A-3 per policy: counts and rates per decision, mean PD of approved (0 if none),
    expected loss rate Σ pd·lgd over approved / n, realised default rate of approved."""
    appr = F.col("decision") == APPROVE
    if label_col and label_col in decided.columns:
        realised = F.avg(F.when(appr, F.col(label_col).cast("double")))
    else:
        realised = F.lit(None).cast("double")
    return _rates(decided.groupBy("policy").agg(
        F.min("policy_order").alias("policy_order"),
        F.count(F.lit(1)).cast("bigint").alias("n_total"),
        F.count_if(appr).cast("bigint").alias("n_approved"),
        F.count_if(F.col("decision") == REVIEW).cast("bigint").alias("n_review"),
        F.count_if(F.col("decision") == DECLINE).cast("bigint").alias("n_declined"),
        F.sum(F.when(appr, F.col("pd"))).alias("_sum_pd"), realised.alias("_adr")), lgd)


def policy_metrics_of_scores(scores: DataFrame, policies: list[Policy], lgd: float = DEFAULT_LGD, id_col: str = "id",
                             pd_col: str = "pd", label_col: str | None = "label") -> DataFrame:
    """``policy_metrics(decide_with_capacity(scores))`` without a decision per row: decisions are counted
    over distinct PDs, and only rows tied at a cut are looked at by id."""
    label = F.col(label_col).cast("double") if label_col and label_col in scores.columns else F.lit(None).cast("double")
    base = scores.select(F.col(id_col).alias("id"), F.col(pd_col).alias("pd"), label.alias("label"))
    base = base.withColumns({"label_n": F.col("label").isNotNull().cast("long"),
                             "label_sum": F.coalesce("label", F.lit(0.0))}).drop("label")
    parts = ["n", "label_n", "label_sum"]
    counted = _policy_rows(base.groupBy("pd").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label_n").alias("label_n"), F.sum("label_sum").alias("label_sum")), policies)
    # What stays in review of the rows tied at the cut; the rest of them is approved.
    cuts = _cut_ids(base, _cuts(counted, policies), len(policies), parts[1:])
    rows = counted.join(F.broadcast(cuts), "policy", "left")
    capped = (F.col("raw") == REVIEW) & F.col("cut_pd").isNotNull()
    at_cut = capped & (F.col("pd") == F.col("cut_pd"))
    demoted = (F.col("raw") == APPROVE) | (capped & (F.col("pd") < F.col("cut_pd")))

    def approved(c: str) -> Column:
        return (F.when(at_cut, F.col(c) - F.coalesce(F.col("kept")[c], F.lit(0))).when(demoted, F.col(c)).otherwise(0))
    rows = rows.select("policy", "policy_order", "pd", "n", "raw", *[approved(c).alias("a_" + c) for c in parts])
    sums = rows.groupBy("policy").agg(
        F.min("policy_order").alias("policy_order"), F.sum("n").cast("bigint").alias("n_total"),
        F.sum("a_n").cast("bigint").alias("n_approved"),
        F.sum(F.when(F.col("raw") == DECLINE, F.col("n")).otherwise(0)).cast("bigint").alias("n_declined"),
        F.sum(F.when(F.col("a_n") > 0, F.col("pd") * F.col("a_n"))).alias("_sum_pd"),
        F.try_divide(F.sum("a_label_sum"), F.sum("a_label_n")).alias("_adr"))
    return _rates(sums.withColumn("n_review", F.col("n_total") - F.col("n_approved") - F.col("n_declined")), lgd)


def compare_policies(scores: DataFrame, policies: list[Policy] | None = None,
                     lgd: float = DEFAULT_LGD, id_col: str = "id", pd_col: str = "pd",
                     label_col: str | None = "label") -> DataFrame:
    """A-4: A-3 for every policy, plus dataset size and mean PD on each row."""
    m = policy_metrics_of_scores(scores, policies or DEFAULT_POLICIES, lgd, id_col, pd_col, label_col)
    ds = scores.agg(F.count(F.lit(1)).cast("bigint").alias("dataset_n"),
                    F.round(F.avg(pd_col), 6).alias("dataset_mean_pd"))
    return attach(m, ds)


def best_policy(metrics: DataFrame) -> DataFrame:
    """A-5: highest approval rate and lowest expected loss; the earlier policy wins ties."""
    return metrics.agg(
        F.max_by("policy", F.struct(F.col("approval_rate"), -F.col("policy_order")))
        .alias("best_approval_policy"),
        F.max("approval_rate").alias("best_approval_rate"),
        F.min_by("policy", F.struct(F.col("expected_loss_rate"), F.col("policy_order")))
        .alias("best_loss_policy"),
        F.min("expected_loss_rate").alias("best_expected_loss_rate"))


def portfolio_summary(scores: DataFrame, pd_col: str = "pd") -> DataFrame:
    """A-6: number of loans, mean PD, loans with PD ≥ 0.5."""
    return scores.agg(F.count(F.lit(1)).cast("bigint").alias("n_loans"),
                      F.round(F.avg(pd_col), 6).alias("mean_pd"),
                      F.count_if(F.col(pd_col) >= 0.5).cast("bigint").alias("n_high_risk"))


def tier_counts(scores: DataFrame, pd_col: str = "pd") -> DataFrame:
    """A-7: loans per risk tier (empty tiers kept) and share of the total."""
    tiers = F.array(*[F.struct(F.lit(i).alias("tier_order"), F.lit(n).alias("tier"))
                      for i, (n, _) in enumerate(RISK_TIERS)])
    counts = scores.groupBy(risk_tier(F.col(pd_col)).alias("tier")).agg(
        F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    dim = total.select("total", F.inline(tiers))
    return dim.join(counts, "tier", "left").select(
        "tier", "tier_order", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
        F.round(F.coalesce(F.try_divide(F.col("n"), F.col("total")), F.lit(0.0)), 6).alias("share"))


def portfolio_sort(scores: DataFrame, pd_col: str = "pd", id_col: str = "id") -> DataFrame:
    """N-7: scored loans by PD descending (range-partitioned global sort), with tier."""
    return (scores.select("*", risk_tier(F.col(pd_col)).alias("tier"))
            .orderBy(F.col(pd_col).desc(), F.col(id_col).asc()))
