"""Side-by-side check of a Spark query against its DuckDB oracle SQL (test helper)."""

from __future__ import annotations

import math

import pandas as pd

from .bindings import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm_value(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if isinstance(v, (list, tuple)):
        return tuple(_norm_value(x) for x in v)
    try:
        import numpy as np

        if isinstance(v, np.generic):
            return _norm_value(v.item())
        if isinstance(v, np.ndarray):
            return tuple(_norm_value(x) for x in v.tolist())
    except ImportError:  # pragma: no cover
        pass
    if isinstance(v, dict):
        return tuple(sorted((k, _norm_value(x)) for k, x in v.items()))
    if isinstance(v, (int, bool)):
        return float(v) if isinstance(v, bool) else v
    return v


def normalize(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm_value(r[c]) for c in cols) for r in df.to_dict("records")]
    key = lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    return sorted(rows, key=key)


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame, tol: float = 1e-6) -> list[str]:
    """Return a list of differences (empty when equal)."""
    problems = []
    if sorted(spark_pdf.columns) != sorted(oracle_pdf.columns):
        return [f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(oracle_pdf.columns)}"]
    if len(spark_pdf) != len(oracle_pdf):
        problems.append(f"row count {len(spark_pdf)} vs {len(oracle_pdf)}")
    a, b = normalize(spark_pdf), normalize(oracle_pdf)
    cols = sorted(spark_pdf.columns)
    for i, (ra, rb) in enumerate(zip(a, b)):
        for c, x, y in zip(cols, ra, rb):
            if isinstance(x, (int, float)) and isinstance(y, (int, float)) and x is not None:
                if abs(float(x) - float(y)) > tol * max(1.0, abs(float(y))):
                    problems.append(f"row {i} col {c}: {x!r} vs {y!r}")
            elif x != y and not (isinstance(x, (int, float)) and isinstance(y, (int, float))):
                problems.append(f"row {i} col {c}: {x!r} vs {y!r}")
        if len(problems) > 8:
            break
    return problems
