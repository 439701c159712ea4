"""Helpers shared by the training-data operators: table access, stage tables, Arrow batches.

Words are maximal runs of characters outside space and U+0009-U+000D, which is what
``bytes.split()`` cuts UTF-8 text into (no multi-byte sequence holds one of those bytes).
"""

from __future__ import annotations

import atexit
import functools
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyrisk.session import scratch_path, ship_package

CHUNK_CHARS = 4 << 20   # texts handled at once inside a task (one longer text is its own chunk)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _drop_path(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone; the folder is the cluster's scratch space
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    atexit.register(_drop_path, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def guarded(*needs: str):
    """For a function that returns the columns of its first frame: the columns that it does not need are renamed
    while it runs, by position, so that no name of theirs can meet one of its own."""
    def deco(fn):
        @functools.wraps(fn)
        def run(docs: DataFrame, *args, **named) -> DataFrame:
            safe = docs.toDF(*[c if c in needs else f"other column {i}" for i, c in enumerate(docs.columns)])
            return fn(safe, *args, **named).toDF(*docs.columns)
        return run
    return deco


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def chunks(texts: list[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose texts hold about ``limit`` characters at most."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def append_columns(df: DataFrame, inputs: list[str], fields: list[T.StructField],
                   make: Callable[[], Callable[..., list[list]]]) -> DataFrame:
    """``df`` plus columns computed from whole values of ``inputs``; other columns pass through.

    ``make()`` runs once per task and returns ``fn(*lists) -> lists``, one per new field.
    A new field replaces a column of the same name.
    """
    new = [f.name for f in fields]
    base = df.drop(*new) if any(c in new for c in df.columns) else df
    lost = [c for c in inputs if c not in base.columns]
    if lost:
        raise ValueError(f"input columns {lost} would be replaced by the output")
    return map_arrow(base, _appender(inputs, fields, make), T.StructType(base.schema.fields + fields))


def _appender(inputs, fields, make):
    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        types = [f.type for f in to_arrow_schema(T.StructType(fields))]
        fn = make()
        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in inputs]
            sized = max(cols, key=lambda c: sum(len(x) for x in c if isinstance(x, str)))
            for lo, hi in chunks([x if isinstance(x, str) else None for x in sized]):
                part = b.slice(lo, hi - lo)
                out = fn(*[c[lo:hi] for c in cols])
                yield pa.RecordBatch.from_arrays(
                    part.columns + [pa.array(v, t) for v, t in zip(out, types)],
                    names=part.schema.names + [f.name for f in fields])
    return run


def project_columns(df: DataFrame, keep: list[str], inputs: list[str], fields: list[T.StructField],
                    make: Callable[[], Callable[..., list[list]]]) -> DataFrame:
    """Like ``append_columns`` but returns only ``keep`` and the new columns (texts stay in the task)."""
    need = list(dict.fromkeys(keep + inputs))
    run = _appender(inputs, fields, make)
    names = keep + [f.name for f in fields]

    def narrow(batches):
        for b in run(batches):
            yield b.select(names)
    src = df.select(*[f"`{c}`" for c in need])
    kept = [src.schema[c] for c in keep]
    return map_arrow(src, narrow, T.StructType(kept + fields))


def index_words(texts: list[str | None], lower: bool = False) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words in first-seen order, the word number of each token, and text offsets."""
    seen: dict[bytes, int] = defaultdict()
    seen.default_factory = seen.__len__
    get = seen.__getitem__
    parts, offsets = [], np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        words = (t.encode().lower() if lower else t.encode()).split() if t else []
        parts.append(np.fromiter(map(get, words), np.int32, len(words)))
        offsets[i + 1] = offsets[i] + len(words)
    return list(seen), (np.concatenate(parts) if parts else np.zeros(0, np.int32)), offsets


def sum_by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per-text sums of token values (0 for texts without tokens)."""
    total = np.concatenate([np.zeros((1,) + values.shape[1:]), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def lookup(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``keys`` in the sorted ``table`` and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def merge_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)
