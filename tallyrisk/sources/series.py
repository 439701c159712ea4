"""Macro series landed on disk: JSON observation documents, header CSV files, and the
monthly macro Parquet with its reuse-unless-overwrite rule (S-9..S-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import to_double
from ..operators import macro as MC

OBSERVATIONS = T.ArrayType(T.StructType([T.StructField("date", T.StringType()),
                                         T.StructField("value", T.StringType())]))


def read_series_json(spark: SparkSession, path: str) -> DataFrame:
    """S-9 from files: JSON lines with ``series_id`` and an ``observations`` array."""
    schema = T.StructType([T.StructField("series_id", T.StringType()),
                           T.StructField("observations", OBSERVATIONS)])
    docs = spark.read.schema(schema).json(path)
    obs = docs.select("series_id", F.inline("observations"))
    return obs.select("series_id", F.to_date("date").alias("date"),
                      to_double(F.col("value")).alias("value"))


def read_series_csv(spark: SparkSession, path: str) -> DataFrame:
    """S-10: header CSV ``DATE,<value>``; each file is read by its own header: the value is its
    first column that is not DATE; the series id comes from the folder / file name."""
    lines = spark.read.text(path)
    sid = (F.col("series_id") if "series_id" in lines.columns else
           F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", ""))
    lines = lines.select(sid.cast("string").alias("series_id"), F.col("_metadata.file_path").alias("_file"),
                         F.transform(F.split("value", ","), lambda x: F.trim(F.regexp_replace(x, '^"|"$', "")))
                         .alias("_f")).where(F.trim(F.array_join("_f", "")) != "")
    names = F.transform("_f", lambda x: F.upper(x))
    # One header per file: the line with a DATE field.
    heads = lines.where(F.array_contains(names, "DATE")).select(
        F.col("_file").alias("_hf"), F.array_position(names, "DATE").cast("int").alias("_d"),
        F.array_position(F.transform(names, lambda x: (x != "DATE") & (x != "SERIES_ID")), True).cast("int").alias("_v")
    ).dropDuplicates(["_hf"])
    if heads.where("_v > 0").limit(1).count() == 0 and lines.limit(1).count():
        raise ValueError("no value column besides DATE")
    rows = lines.where(~F.array_contains(names, "DATE")).join(heads, F.col("_file") == F.col("_hf")).where("_v > 0")
    return rows.select("series_id", F.expr("try_to_date(try_element_at(_f, _d))").alias("date"),
                       to_double(F.try_element_at("_f", F.col("_v"))).alias("value"))


def write_macro_monthly(spark: SparkSession, obs: DataFrame, methods: dict[str, str], path: str,
                        overwrite: bool = False) -> DataFrame:
    """S-11: per-series resample (P-9) → pivot (A-9) → Parquet. An existing output is
    reused unless ``overwrite``; a series with an unknown method is skipped, and only a
    request without any usable series is an error."""
    from .files import path_exists

    if not overwrite and path_exists(spark, path):
        return spark.read.parquet(path)
    usable = {s: m for s, m in methods.items() if m in MC.RESAMPLE_METHODS}
    if not usable:
        raise ValueError(f"no series with a known resample method: {methods}")
    wide = MC.series_pivot(MC.resample_by_method(obs, usable), sorted(usable))
    wide.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
