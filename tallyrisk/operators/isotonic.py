"""Weighted isotonic regression by ranges of the feature (L-8).

Rows collapse to one point per distinct feature value. Points are cut into ranges; every task pools the
adjacent violators of its own range, so what is left is a rising sequence of blocks. Pooling may go in any
order, so blocks are points again: they are cut into new ranges, half a range further on, until the last block
of every range lies below the first of the next. A pool that swallows a whole range leaves one block of it, so
rounds are few, and neither the points nor the blocks ever meet in one place unless they fit into one range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .ranking import attach, with_range

ROWS_PER_RANGE = 500_000       # points or blocks that one task pools (about)
BLOCKS_PER_ARRAY = 4096        # blocks of a range that a row searches (about)
MAX_BROADCAST_BLOCKS = 200_000
BLOCK_SCHEMA = "_range int, lo double, hi double, s double, w double"


def pool_adjacent(lo: np.ndarray, hi: np.ndarray, s: np.ndarray, w: np.ndarray) -> tuple[list, list, list, list]:
    """Blocks of a sequence sorted by ``lo``, with strictly rising means ``s / w``."""
    out: tuple[list, list, list, list] = ([], [], [], [])
    los, his, sums, weights = out
    for a, b, total, weight in zip(lo.tolist(), hi.tolist(), s.tolist(), w.tolist()):
        while los and sums[-1] * weight >= total * weights[-1]:
            a = los.pop()
            his.pop()
            total += sums.pop()
            weight += weights.pop()
        for column, x in zip(out, (a, b, total, weight)):
            column.append(x)
    return out


def _stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder (a checkpoint would compute it twice)."""
    path = scratch_path(df.sparkSession, "isotonic")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pool(table: pa.Table) -> pa.Table:
    table = table.sort_by("lo")
    names = ("lo", "hi", "s", "w")
    blocks = pool_adjacent(*(table.column(n).to_numpy() for n in names))
    number = pa.array(np.full(len(blocks[0]), table.column("_range")[0].as_py(), np.int32))
    return pa.table({"_range": number, **{n: pa.array(b, pa.float64()) for n, b in zip(names, blocks)}})


def _cut(points: DataFrame, ranges: int, shift: float) -> DataFrame:
    """``points`` with the number of their range; ``shift`` moves the cuts by that part of a range."""
    if ranges == 1:
        return points.withColumn("_range", F.lit(0))
    cuts = [(i + shift) / ranges for i in range(0 if shift else 1, ranges)]
    edges = points.agg(F.percentile_approx("lo", cuts, 100 * ranges).alias("_edges"))
    return with_range(attach(points, edges), "lo", "_edges", len(cuts), False, "_range").drop("_edges")


def _with_next(ends: DataFrame) -> DataFrame:
    """One row a range: the first block of the next range beside it (a window over the ranges, not the blocks)."""
    return ends.withColumn("next", F.lead("first").over(Window.orderBy("_range")))


def isotonic_blocks(df: DataFrame, x: str, y: str, weight: str | None = None,
                    rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """lo, hi, s, w of the blocks of the rising fit of ``y`` on ``x``; a block's value is ``s / w``.

    Rows with a null or NaN in ``x`` or ``y`` and rows whose weight is not positive take no part; equal ``x``
    are one point with their weighted mean; an empty frame has no blocks.
    """
    if rows_per_range < 8:
        raise ValueError("a range holds at least 8 points")   # cuts of two rounds in turn must differ
    spark = df.sparkSession
    ship_package(spark)
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.select(F.col(x).cast("double").alias("lo"), F.col(y).cast("double").alias("_y"), w.alias("_w"))
    rows = rows.where(F.col("lo").isNotNull() & F.col("_y").isNotNull() & (F.col("_w") > 0)
                      & ~F.isnan("lo") & ~F.isnan("_y") & ~F.isnan("_w"))
    points = _stored(rows.groupBy("lo").agg(F.sum(F.col("_y") * F.col("_w")).alias("s"), F.sum("_w").alias("w")).select(
        "lo", F.col("lo").alias("hi"), "s", "w"))
    shift, block = 0.0, F.struct("lo", "hi", "s", "w")
    while True:
        ranges = max(1, -(-points.count() // rows_per_range))
        pooled = _stored(_cut(points, ranges, shift).groupBy("_range").applyInArrow(_pool, BLOCK_SCHEMA))
        points = pooled.drop("_range")
        if ranges == 1:
            return points
        # The blocks of one range rise, so only neighbours on two sides of a cut can still violate.
        ends = _with_next(pooled.groupBy("_range").agg(
            F.min_by(block, "lo").alias("first"), F.max_by(block, "lo").alias("last")))
        if not ends.where("last.s * next.w >= next.s * last.w").limit(1).count():
            return points
        shift = 0.5 - shift


def isotonic_map(blocks: DataFrame, per_array: int = BLOCKS_PER_ARRAY, max_broadcast: int = MAX_BROADCAST_BLOCKS):
    """A function ``(df, x, out) -> df`` that adds the fitted value of ``x``: the block's value inside a block, on
    the straight line between two blocks, the outer values beyond them; null for a null or NaN ``x`` and
    without blocks.

    Blocks lie in arrays by range, about ``per_array`` a row: a value finds its range in the list of the ranges'
    first values and its block in that range's array. Arrays of up to ``max_broadcast`` blocks are broadcast, more
    are joined by range.
    """
    n = blocks.count()
    ranges = max(1, -(-n // per_array))
    item = F.struct("lo", "hi", (F.col("s") / F.col("w")).alias("value"))
    table = _cut(blocks, ranges, 0.0).groupBy("_range").agg(F.array_sort(F.collect_list(item)).alias("_blocks"))
    table = _with_next(table.withColumn("first", F.get("_blocks", F.lit(0)))).select(
        "_range", F.col("next").alias("_next"), "_blocks", F.transform("_blocks", lambda b: b["lo"]).alias("_lows"))
    table = _stored(table)
    longest = table.agg(F.max(F.size("_lows")).alias("n")).first()["n"] or 0
    # Starts of all ranges but the first: as many as there are ranges.
    starts = [(r["_range"], r["lo"]) for r in table.select("_range", F.get("_lows", F.lit(0)).alias("lo")).collect()]
    starts.sort(key=lambda r: r[1])
    few = n <= max_broadcast

    def apply(df: DataFrame, x: str, out: str) -> DataFrame:
        if not starts:
            return df.withColumn(out, F.lit(None).cast("double"))
        names = df.columns
        at = df.withColumn("_x", F.when(~F.isnan(F.col(x).cast("double")), F.col(x).cast("double")))
        # A start equal to the value opens its range: the starts below it or equal to it are counted.
        at = at.withColumn("_starts", F.array(*[F.lit(lo) for _, lo in starts[1:]]).cast("array<double>"))
        at = with_range(at, "_x", "_starts", len(starts) - 1, False, "_at")
        at = at.withColumn("_at", F.col("_at") + F.coalesce(F.get("_starts", F.col("_at")) == F.col("_x"), F.lit(False)).cast("int"))
        at = at.withColumn("_range", F.get(F.array(*[F.lit(r) for r, _ in starts]), F.col("_at")))
        at = at.join(F.broadcast(table) if few else table, "_range", "left")
        at = with_range(at, "_x", "_lows", longest, False, "_at")
        at = at.withColumn("_at", F.col("_at") - 1 + F.coalesce(F.get("_lows", F.col("_at")) == F.col("_x"), F.lit(False)).cast("int"))
        below = F.get("_blocks", F.col("_at"))
        above = F.coalesce(F.get("_blocks", F.col("_at") + 1), F.col("_next"))
        at = at.withColumn("_below", F.when(F.col("_at") >= 0, below)).withColumn("_above", above)
        part = (F.col("_x") - F.col("_below.hi")) / (F.col("_above.lo") - F.col("_below.hi"))
        line = F.col("_below.value") + (F.col("_above.value") - F.col("_below.value")) * part
        value = (F.when(F.col("_x").isNull(), None).when(F.col("_below").isNull(), F.col("_above.value"))
                 .when((F.col("_x") <= F.col("_below.hi")) | F.col("_above").isNull(), F.col("_below.value"))
                 .otherwise(line))
        return at.select(*[c for c in names if c != out], value.alias(out))
    return apply
