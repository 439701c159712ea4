"""Loan-tape ingestion: positional pipe-delimited readers, quarter pruning, typed
Parquet with validation beside the data, and the combined-tape split
(S-1..S-6, W-2, P-6).

One read covers all files of a layout (input splits replace the reference's
chunking); the quarter comes from the file path through ``_metadata``; the
output is partitioned by quarter and written with dynamic partition
overwrite, so re-ingesting a quarter replaces only that quarter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import coerce_types, normalize_blanks, parse_period
from ..operators.validate import ORIGINATION_RULES, PERFORMANCE_RULES, validate

# ---------------------------------------------------------------------------
# File layouts (column order) and combined-tape positions.
# ---------------------------------------------------------------------------
ORIGINATION_COLUMNS = [
    "credit_score", "first_payment_date", "first_time_homebuyer_flag", "maturity_date", "msa",
    "mi_pct", "num_units", "occupancy_status", "orig_cltv", "orig_dti", "orig_upb", "orig_ltv",
    "orig_interest_rate", "channel", "ppm_flag", "amortization_type", "property_state",
    "property_type", "postal_code", "loan_sequence_number", "loan_purpose", "orig_loan_term",
    "num_borrowers", "seller_name", "servicer_name", "super_conforming_flag",
    "pre_harp_loan_seq_num", "program_indicator", "harp_indicator", "property_valuation_method",
    "io_indicator", "mi_cancellation_indicator",
]
PERFORMANCE_COLUMNS = [
    "loan_sequence_number", "monthly_reporting_period", "current_actual_upb",
    "current_delinquency_status", "loan_age", "remaining_months_to_legal_maturity",
    "repurchase_flag", "modification_flag", "zero_balance_code", "zero_balance_effective_date",
    "current_interest_rate", "current_deferred_upb", "due_date_of_last_paid_installment",
    "mi_recoveries", "net_sales_proceeds", "non_mi_recoveries", "expenses", "legal_costs",
    "maintenance_and_preservation_costs", "taxes_and_insurance", "miscellaneous_expenses",
    "actual_loss_calculation", "modification_cost", "step_modification_flag",
    "deferred_payment_plan", "estimated_ltv", "zero_balance_removal_upb",
    "delinquent_accrued_interest", "delinquency_due_to_disaster",
    "borrower_assistance_status_code", "current_month_modification_cost", "interest_bearing_upb",
]
COMBINED_WIDTH = 110
COMBINED_ORIG_POSITIONS = {
    "loan_sequence_number": 1, "channel": 3, "seller_name": 4, "servicer_name": 5,
    "orig_interest_rate": 7, "orig_upb": 9, "orig_loan_term": 12, "first_payment_date": 13,
    "maturity_date": 18, "orig_ltv": 19, "orig_cltv": 20, "num_borrowers": 21, "orig_dti": 22,
    "credit_score": 23, "first_time_homebuyer_flag": 25, "occupancy_status": 26,
    "property_type": 27, "num_units": 28, "loan_purpose": 29, "property_state": 30,
    "postal_code": 31, "msa": 32, "mi_pct": 33, "amortization_type": 34,
    "super_conforming_flag": 35, "ppm_flag": 36, "current_delinquency_status": 39,
    "modification_flag": 41,
}
COMBINED_PERF_POSITIONS = {
    "loan_sequence_number": 1, "monthly_reporting_period": 2, "current_interest_rate": 8,
    "current_actual_upb": 11, "loan_age": 15, "remaining_months_to_legal_maturity": 16,
    "current_delinquency_status": 39, "modification_flag": 41,
}
QUARTER_PATTERN = r"(?i)(\d{4}Q[1-4])"
ORIGINATION_TYPES = {
    "credit_score": "double", "mi_pct": "double", "orig_cltv": "double", "orig_dti": "double",
    "orig_upb": "double", "orig_ltv": "double", "orig_interest_rate": "double", "msa": "long",
    "num_units": "long", "orig_loan_term": "long", "num_borrowers": "long",
}
PERFORMANCE_TYPES = {
    "current_actual_upb": "double", "loan_age": "long", "remaining_months_to_legal_maturity": "long",
    "current_interest_rate": "double", "current_deferred_upb": "double", "mi_recoveries": "double",
    "non_mi_recoveries": "double", "expenses": "double", "legal_costs": "double",
    "maintenance_and_preservation_costs": "double", "taxes_and_insurance": "double",
    "miscellaneous_expenses": "double", "actual_loss_calculation": "double",
    "modification_cost": "double", "estimated_ltv": "double", "zero_balance_removal_upb": "double",
    "delinquent_accrued_interest": "double", "current_month_modification_cost": "double",
    "interest_bearing_upb": "double",
}
TAPE_OPTIONS = {"sep": "|", "encoding": "ISO-8859-1", "header": "false", "mode": "PERMISSIVE",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_delimited_tape(spark: SparkSession, paths: str | list[str], columns: list[str],
                        width: int | None = None) -> DataFrame:
    """S-1: headerless pipe-delimited latin-1 text, every field a string, named by position.

    Extra trailing fields are dropped, missing trailing fields are NULL. ``width`` reads
    that many positional columns ``_c0…`` (for the combined tape). ``_place`` orders rows as the
    files hold them: path, start of the split, and the row's number in its task, which only
    compares rows of one split, so it holds however the files are split.
    """
    names = columns if width is None else [f"_c{i}" for i in range(width)]
    r = spark.read.options(**TAPE_OPTIONS).schema(string_schema(names))
    df = r.csv(paths)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("row"))
    return df.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_name").alias("_file_name"), place.alias("_place"))


def quarter_of(file_name_col: str = "_file_name", file_path_col: str = "_file") -> F.Column:
    """S-6: ``\\d{4}Q[1-4]`` (any case, upper-cased) from the file name, else from the path,
    else the file stem (a compressed tape's is that of the plain one)."""
    def found(c: F.Column) -> F.Column:      # NULL without a match; no regex where there is no Q at all
        return F.when(c.contains("Q") | c.contains("q"),
                      F.get(F.regexp_extract_all(c, F.lit(QUARTER_PATTERN), F.lit(1)), F.lit(0)))
    name, path = F.col(file_name_col), F.col(file_path_col)
    name = F.when(name.endswith(".gz"), F.substring(name, F.lit(1), F.length(name) - 3)).otherwise(name)
    suffix = F.substring_index(name, ".", -1)
    stem = F.when(name.contains("."), F.substring(name, F.lit(1), F.length(name) - F.length(suffix) - 1)).otherwise(name)
    # coalesce stops at the first that is there, and evaluates each once.
    return F.upper(F.coalesce(found(F.col(file_name_col)), found(path), stem))


def filter_quarters(df: DataFrame, quarters: list[str] | None) -> DataFrame:
    """W-2: keep the wanted quarters; an empty list keeps all."""
    if not quarters:
        return df
    return df.where(F.col("quarter").isin([q.upper() for q in quarters]))


def typed_tape(raw: DataFrame, types: dict[str, str], rules, period_col: str | None) -> DataFrame:
    """Blanks → NULL, rules checked on the text, numbers coerced; violations kept beside."""
    cols = [c for c in raw.columns if not c.startswith("_")]
    clean = normalize_blanks(raw.select(*cols))
    checked = validate(clean, rules)
    typed = coerce_types(checked, {k: v for k, v in types.items() if k in checked.columns})
    if period_col and period_col in typed.columns:
        typed = typed.withColumn("period_month", parse_period(F.col(period_col)))
    return typed


def _existing_quarters(spark: SparkSession, out_dir: str) -> list[str]:
    """Quarters already written under ``out_dir``, from its partition folders (no data is read)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n.partition("=")[2] for n in names if n.startswith("quarter="))


def ingest_tape(spark: SparkSession, paths: str | list[str], layout: str, out_dir: str,
                quarters: list[str] | None = None, overwrite: bool = False) -> DataFrame | None:
    """S-2 / S-3: read → quarter → prune → clean → validate → Parquet by quarter.

    Quarters already present in ``out_dir`` are skipped unless ``overwrite``
    (dynamic partition overwrite replaces only the re-ingested quarters).
    Returns the ingested frame read back from ``out_dir``, None where nothing was ever written.
    """
    if layout == "origination":
        cols, types, rules, per = ORIGINATION_COLUMNS, ORIGINATION_TYPES, ORIGINATION_RULES, "first_payment_date"
    elif layout == "performance":
        cols, types, rules, per = PERFORMANCE_COLUMNS, PERFORMANCE_TYPES, PERFORMANCE_RULES, "monthly_reporting_period"
    else:
        raise ValueError(f"unknown layout {layout!r}")
    raw = read_delimited_tape(spark, paths, cols).withColumn("quarter", quarter_of())
    _write_quarters(typed_tape(filter_quarters(raw, quarters), types, rules, per), out_dir, overwrite)
    return _produced(spark, out_dir, quarters)


def _write_quarters(typed: DataFrame, out_dir: str, overwrite: bool) -> None:
    """Write by quarter; quarters that are there already are left alone unless ``overwrite``."""
    done = [] if overwrite else _existing_quarters(typed.sparkSession, out_dir)
    if done:
        typed = typed.where(~F.col("quarter").isin(done))
    (typed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("quarter").parquet(out_dir))


def _produced(spark: SparkSession, out_dir: str, quarters: list[str] | None) -> DataFrame | None:
    wanted = {q.upper() for q in quarters or []}
    there = [q for q in _existing_quarters(spark, out_dir) if not wanted or q in wanted]
    return load_processed(spark, out_dir, quarters) if there else None


def load_processed(spark: SparkSession, out_dir: str, quarters: list[str] | None = None) -> DataFrame:
    """S-8 / S-12: all ingested quarters (partition-pruned when ``quarters`` is given),
    schemas merged across quarters."""
    df = spark.read.option("mergeSchema", "true").parquet(out_dir)
    return filter_quarters(df, quarters)


def split_combined_tape(spark: SparkSession, paths: str | list[str],
                        quarters: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """S-4: one wide read → (origination, performance) by position maps.

    Performance keeps every row; origination keeps the first row per quarter and loan in file
    order (P-6), taken with ``min_by`` so a long loan history is combined map-side.
    """
    raw = read_delimited_tape(spark, paths, [], width=COMBINED_WIDTH).withColumn("quarter", quarter_of())
    raw = filter_quarters(raw, quarters)

    def take(layout: list[str], pos: dict[str, int]):
        return [(F.col(f"_c{pos[c]}") if c in pos else F.lit(None).cast("string")).alias(c)
                for c in layout]

    perf = raw.select(*take(PERFORMANCE_COLUMNS, COMBINED_PERF_POSITIONS), "quarter")
    orig_rows = raw.select(*take(ORIGINATION_COLUMNS, COMBINED_ORIG_POSITIONS), "quarter", "_place")
    first = orig_rows.groupBy("quarter", "loan_sequence_number").agg(
        F.min_by(F.struct(*[F.col(c) for c in ORIGINATION_COLUMNS if c != "loan_sequence_number"]),
                 F.col("_place")).alias("r"))
    orig = first.select("quarter", "loan_sequence_number", "r.*").select(*ORIGINATION_COLUMNS, "quarter")
    return orig, perf


def ingest_all(spark: SparkSession, orig_paths: list[str], perf_paths: list[str],
               combined_paths: list[str], out_dir: str, quarters: list[str] | None = None,
               overwrite: bool = False) -> dict[str, DataFrame]:
    """S-5: classic layouts first; the combined tape only when both produced nothing."""
    dirs = {"origination": f"{out_dir}/origination", "performance": f"{out_dir}/performance"}
    out = {}
    for layout, paths in (("origination", orig_paths), ("performance", perf_paths)):
        got = ingest_tape(spark, paths, layout, dirs[layout], quarters, overwrite) if paths else None
        if got is not None:
            out[layout] = got
    if not out and combined_paths:
        o, p = split_combined_tape(spark, combined_paths, quarters)
        _write_quarters(typed_tape(p, PERFORMANCE_TYPES, PERFORMANCE_RULES, "monthly_reporting_period"),
                        dirs["performance"], overwrite)
        # Loans come dealt by key, every quarter in every task; a file per task and quarter would be tasks x quarters files.
        o = typed_tape(o, ORIGINATION_TYPES, ORIGINATION_RULES, "first_payment_date").hint("rebalance", "quarter")
        _write_quarters(o, dirs["origination"], overwrite)
        found = {k: _produced(spark, v, quarters) for k, v in dirs.items()}
        out = {k: v for k, v in found.items() if v is not None}
    return out


def write_tape(df: DataFrame, columns: list[str], out_dir: str, partition_col: str | None = None,
               compression: str = "none") -> None:
    """Write string columns as a headerless pipe-delimited tape (optionally one folder per quarter).

    ``compression`` is a codec of Spark's text writer; a wide tape is mostly separators, but one task reads a whole
    compressed file, so its writer's tasks should be small."""
    sel = [F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c)
           for c in columns]
    if partition_col:
        sel.append(F.col(partition_col))
    w = df.select(*sel).write.mode("overwrite").options(
        sep="|", encoding="ISO-8859-1", header="false", quoteAll="false", compression=compression,
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", emptyValue="")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.csv(out_dir)
