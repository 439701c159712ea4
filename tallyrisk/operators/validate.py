"""Rule-based validation as data (M-12, M-13).

Rules are rows (rule id, column, kind, bounds / allowed set). One ``select``
turns them into an array column of violated rule ids per record; the report is
one aggregate with a conditional count per rule. Failures never block: the data
flows on with its violations beside it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import to_double


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str  # "range" | "gt" | "not_null" | "in_set" | "type"
    lo: float | None = None
    hi: float | None = None
    allowed: tuple[str, ...] = ()
    nullable: bool = True

    @property
    def rule_id(self) -> str:
        return f"{self.column}:{self.kind}"


# ---------------------------------------------------------------------------
# The origination and performance rules of the reference schema.
# ---------------------------------------------------------------------------
ORIGINATION_RULES = [
    Rule("credit_score", "range", 300, 850),
    Rule("first_payment_date", "not_null"),
    Rule("first_time_homebuyer_flag", "in_set", allowed=("Y", "N", "9")),
    Rule("maturity_date", "not_null"),
    Rule("mi_pct", "range", 0, 55),
    Rule("num_units", "range", 1, 4, nullable=False),
    Rule("occupancy_status", "in_set", allowed=("P", "I", "S", "9")),
    Rule("orig_cltv", "range", 0, 200),
    Rule("orig_dti", "range", 0, 65),
    Rule("orig_upb", "gt", 0, nullable=False),
    Rule("orig_ltv", "range", 0, 200),
    Rule("orig_interest_rate", "range", 0, 20, nullable=False),
    Rule("channel", "in_set", allowed=("R", "B", "C", "T", "9")),
    Rule("ppm_flag", "in_set", allowed=("Y", "N")),
    Rule("amortization_type", "in_set", allowed=("FRM", "ARM")),
    Rule("property_type", "in_set", allowed=("SF", "PU", "CO", "MH", "CP")),
    Rule("loan_sequence_number", "not_null"),
    Rule("loan_purpose", "in_set", allowed=("P", "C", "N", "R", "9")),
    Rule("orig_loan_term", "range", 1, 480, nullable=False),
    Rule("super_conforming_flag", "in_set", allowed=("Y", "N", " ", "")),
    Rule("harp_indicator", "in_set", allowed=("Y", "N", " ", "")),
    Rule("io_indicator", "in_set", allowed=("Y", "N")),
]
PERFORMANCE_RULES = [
    Rule("loan_sequence_number", "not_null"),
    Rule("monthly_reporting_period", "not_null"),
    Rule("modification_flag", "in_set", allowed=("Y", "N", " ", "")),
    Rule("step_modification_flag", "in_set", allowed=("Y", "N", " ", "")),
    Rule("deferred_payment_plan", "in_set", allowed=("Y", "N", " ", "")),
    Rule("delinquency_due_to_disaster", "in_set", allowed=("Y", "N", " ", "")),
]
# Typed columns without a range rule: text that does not coerce is a violation.
ORIGINATION_RULES += [Rule(c, "type") for c in ("msa", "num_borrowers")]
PERFORMANCE_RULES += [Rule(c, "type") for c in (
    "current_actual_upb", "loan_age", "remaining_months_to_legal_maturity", "current_interest_rate",
    "current_deferred_upb", "mi_recoveries", "non_mi_recoveries", "expenses", "legal_costs",
    "maintenance_and_preservation_costs", "taxes_and_insurance", "miscellaneous_expenses",
    "actual_loss_calculation", "modification_cost", "estimated_ltv", "zero_balance_removal_upb",
    "delinquent_accrued_interest", "current_month_modification_cost", "interest_bearing_upb")]


def _violation(rule: Rule, raw: Column) -> list[tuple[str, Column]]:
    """(rule id, violated?) pairs for one rule on a raw (blank-normalised) column."""
    out = []
    if rule.kind == "not_null":
        return [(rule.rule_id, raw.isNull())]
    if rule.kind == "in_set":
        return [(rule.rule_id, raw.isNotNull() & ~raw.isin(*rule.allowed))]
    v = to_double(raw)
    # Text that does not coerce is its own violation (the reference's coercion failure).
    out.append((f"{rule.column}:type", raw.isNotNull() & v.isNull()))
    if not rule.nullable:
        out.append((f"{rule.column}:not_null", raw.isNull()))
    if rule.kind == "range":
        out.append((rule.rule_id, v.isNotNull() & ~v.between(rule.lo, rule.hi)))
    elif rule.kind == "gt":
        out.append((rule.rule_id, v.isNotNull() & ~(v > rule.lo)))
    return out


def violations_column(df: DataFrame, rules: list[Rule]) -> Column:
    """``array<string>`` of the rule ids each row violates (columns absent → rule skipped)."""
    have = set(df.columns)
    checks = []
    for r in rules:
        if r.column in have:
            checks += _violation(r, F.col(r.column))
    if not checks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(c, F.lit(rid)) for rid, c in checks]))


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The data with a ``violations`` array column; nothing is dropped."""
    return df.withColumn("violations", violations_column(df, rules))


def violation_report(df: DataFrame, rules: list[Rule], id_col: str) -> DataFrame:
    """One row per violated rule: count and the smallest offending id.

    A single aggregate with one conditional count / min per rule (map-side partial
    aggregation, no row multiplication), then unpivoted to rows.
    """
    have = set(df.columns)
    checks = []
    for r in rules:
        if r.column in have:
            checks += _violation(r, F.col(r.column))
    if not checks:
        return df.sparkSession.createDataFrame([], "rule string, n_violations bigint, first_id bigint")
    ident = F.col(id_col)
    aggs = []
    for i, (rid, cond) in enumerate(checks):
        aggs.append(F.struct(F.lit(rid).alias("rule"), F.count_if(cond).alias("n_violations"),
                             F.min(F.when(cond, ident)).alias("first_id")).alias(f"r{i}"))
    one = df.agg(*aggs)
    rows = one.select(F.inline(F.array(*[F.col(f"r{i}") for i in range(len(checks))])))
    return rows.where(F.col("n_violations") > 0).select(
        "rule", F.col("n_violations").cast("bigint"), "first_id")
