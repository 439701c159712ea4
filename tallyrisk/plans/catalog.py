"""Registered queries (Spark) and their DuckDB oracle SQL, keyed by SURVEY §2 names.

Each query takes ``(spark, sf_dir)``, reads the driver's tables through
``bindings`` and returns a lazy DataFrame. Each oracle is an independent SQL
formulation over the same tables; both alias every output column identically
and round doubles to 6 digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query builder (and optionally its oracle SQL) under ``name``."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    import importlib.util

    for m in _MODULES:
        if importlib.util.find_spec(f"{__package__}.{m}") is not None:
            importlib.import_module(f"{__package__}.{m}")


_MODULES = ["q_labels", "q_features", "q_metrics", "q_drift", "q_policy", "q_perf", "q_macro",
            "q_forecast", "q_split", "q_sources", "q_models", "q_streaming"]


def present(df: DataFrame) -> DataFrame:
    """Render DATE / TIMESTAMP output columns as ISO text (stable across engines)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        else:
            cols.append(c)
            continue
        cols.append(c.alias(f.name))
    return df.select(cols)
