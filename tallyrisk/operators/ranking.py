"""Distributed prefix sums, ranks and exact quantiles.

A window without ``partitionBy`` moves every row into one task, and a window
partitioned by a hot group does the same for that group. The cumulative sum
here first collapses rows to distinct ``(group, order value)`` keys, then
splits every group into value ranges found by ``percentile_approx``; the
range totals (groups × buckets rows, bounded by ``buckets`` per group) give
per-range offsets, and the running sum inside a range is an ordinary window
partitioned by ``(group, range)``. Equal order values always land in the same
range, so ties are never split.

Edges and offsets hold ``#groups × ranges`` rows. The caller states a bound on
its groups (features, periods, policies) as ``max_groups``, or they are counted
once; within ``MAX_BROADCAST_ROWS`` both tables are broadcast, beyond it they
are joined on ``(group, salt)``, so that a hot group still spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of the edge / offset tables that may be broadcast.
MAX_BROADCAST_ROWS = 2_000_000
SALTS = 64


def _grp(group_cols: list[str]) -> list[Column]:
    return [F.col(g) for g in group_cols]


def _bucket_count(spark) -> int:
    """Ranges per group: a few per shuffle partition."""
    return max(8, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_range(df: DataFrame, value: str, edges: str, n_edges: int, descending: bool, out: str) -> DataFrame:
    """``out`` = number of edges strictly below ``value`` (above, when descending) in a sorted edge
    array: a binary search of O(log n) generated comparisons, one projection per step."""
    def before(at: Column) -> Column:
        e, v = F.get(edges, at), F.col(value)
        return (e > v) if descending else (e < v)

    step = 1 << max(n_edges, 1).bit_length() - 1
    df = df.withColumn(out, F.lit(0))
    while step:
        at = F.col(out) + F.lit(step)
        df = df.withColumn(out, F.when((at <= F.size(edges)) & before(at - 1), at).otherwise(F.col(out)))
        step >>= 1
    return df


def _join_small(big: DataFrame, small: DataFrame, keys: list[str], broadcast: bool, spread: Column) -> DataFrame:
    """Join a per-group table: broadcast, or on (keys, salt) with the small side repeated per salt."""
    if broadcast:
        return big.join(F.broadcast(small), keys, "inner")
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).join(
        salted, [*keys, "_salt"], "inner").drop("_salt")


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row of ``df``.

    The one-row side is broadcast; this is a scalar lookup, not a pairing of rows.
    """
    return df.join(F.broadcast(one_row), how="inner")


def rows_up_to(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> int:
    """The number of rows, or ``limit + 1`` for any number beyond it (one job)."""
    return df.limit(limit + 1).count()


def cumulative(df: DataFrame, group_cols: list[str], order_col: str, sum_cols: list[str],
               descending: bool = False, buckets: int | None = None,
               prefix: str = "cum_", max_groups: int | None = None) -> DataFrame:
    """Running sums of ``sum_cols`` per group, ordered by ``order_col``.

    Input rows are first collapsed to distinct ``(group, order)`` keys (sums of
    ``sum_cols``); the output has one row per such key with the collapsed sums
    and ``prefix + c`` = inclusive running sum (all keys ordered before it plus
    itself). ``descending`` orders from the largest value.
    ``buckets=1`` uses a plain window per group (right for many small groups).
    ``max_groups`` bounds the number of groups; without it they are counted (one job).
    """
    g = list(group_cols)
    collapsed = df.groupBy(*_grp(g), F.col(order_col)).agg(
        *[F.sum(c).alias(c) for c in sum_cols])
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    if buckets == 1:
        w = (Window.partitionBy(*_grp(g)) if g else Window.partitionBy(F.lit(0)))
        w = w.orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return collapsed.select("*", *[F.sum(c).over(w).alias(prefix + c) for c in sum_cols])

    nb = buckets or _bucket_count(df.sparkSession)
    gk = g if g else ["_g0"]
    if not g:
        collapsed = collapsed.withColumn("_g0", F.lit(0))
    limit = MAX_BROADCAST_ROWS // nb
    if not g:
        max_groups = 1
    if max_groups is None:
        max_groups = rows_up_to(df.select(*_grp(g)).distinct(), limit)
    small = max_groups <= limit
    probs = [i / nb for i in range(1, nb)]
    edges = collapsed.groupBy(*_grp(gk)).agg(
        F.percentile_approx(F.col(order_col), probs, max(10_000, 2 * nb)).alias("_edges"))
    if descending:
        edges = edges.withColumn("_edges", F.reverse("_edges"))
    with_edges = _join_small(collapsed, edges, gk, small, F.col(order_col))
    bucketed = with_range(with_edges, order_col, "_edges", nb - 1, descending, "_bkt").drop("_edges")
    totals = bucketed.groupBy(*_grp(gk), "_bkt").agg(*[F.sum(c).alias("_t_" + c) for c in sum_cols])
    wt = Window.partitionBy(*_grp(gk)).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*_grp(gk), "_bkt", *[
        F.coalesce(F.sum("_t_" + c).over(wt), F.lit(0)).alias("_off_" + c) for c in sum_cols])
    # Beyond the broadcast bound the offsets join on (group, range), which spreads by itself.
    joined = bucketed.join(F.broadcast(offsets) if small else offsets, gk + ["_bkt"], "inner")
    w = (Window.partitionBy(*_grp(gk), "_bkt").orderBy(o)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = joined.select(*[F.col(c) for c in collapsed.columns if c != "_g0"],
                        *[(F.sum(c).over(w) + F.col("_off_" + c)).alias(prefix + c)
                          for c in sum_cols])
    return out


def quantiles_from_prefix(cum: DataFrame, counts: DataFrame, group_cols: list[str], value_col: str,
                          count_col: str, cum_col: str, n_col: str, probs: list[float],
                          max_groups: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles from prefix counts.

    ``cum`` has one row per distinct ``(group…, value)`` with its count ``count_col`` and
    inclusive prefix ``cum_col``; ``counts`` has ``n_col`` per group. Each requested position
    ``p·(n−1)`` needs the values at ranks ⌊pos⌋ and ⌈pos⌉: the rows whose rank range covers
    them are found by a join against the tiny broadcast table of target ranks.
    Returns ``(group…, q_index, prob, value)``.
    """
    g = list(group_cols)
    tg = counts.where(F.col(n_col) > 0).select(
        *_grp(g), n_col, F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("q_index", "prob"))
    tg = tg.select(*_grp(g), "q_index", "prob", (F.col("prob") * (F.col(n_col) - 1)).alias("_pos"))
    tg = tg.select("*", F.floor("_pos").cast("long").alias("_lo"), F.ceil("_pos").cast("long").alias("_hi"))
    ranks = tg.select(*_grp(g), F.col("_lo").alias("_r")).union(
        tg.select(*_grp(g), F.col("_hi").alias("_r"))).distinct()
    rows = cum.where(F.col(count_col) > 0).select(*_grp(g), F.col(value_col).alias("_v"),
                                                  F.col(count_col).alias("_c"), F.col(cum_col).alias("_cum"))
    cond = [rows[c].eqNullSafe(ranks[c]) for c in g] + [
        (rows["_cum"] - rows["_c"]) <= ranks["_r"], ranks["_r"] < rows["_cum"]]
    # Target ranks: at most 2·#probs rows a group. Broadcast when ungrouped or the groups are known to be few;
    # else the planner / AQE sizes the join from the measured table.
    few = not g or (max_groups is not None and 2 * len(probs) * max_groups <= MAX_BROADCAST_ROWS)
    rk = F.broadcast(ranks) if few else ranks
    at = rows.join(rk, cond, "inner").select(*[rows[c] for c in g], ranks["_r"], rows["_v"])
    lo = at.select(*_grp(g), F.col("_r").alias("_lo"), F.col("_v").alias("_vlo"))
    hi = at.select(*_grp(g), F.col("_r").alias("_hi"), F.col("_v").alias("_vhi"))
    res = tg.join(lo, g + ["_lo"]).join(hi, g + ["_hi"])
    val = F.col("_vlo") + (F.col("_pos") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))
    return res.select(*_grp(g), "q_index", "prob", val.alias("value"))


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str,
                    probs: list[float], buckets: int | None = None, max_groups: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy's default) per group.

    Returns ``(group…, q_index INT, prob DOUBLE, value DOUBLE)``. NULL values are
    ignored; a group with no values yields no rows. Works from distinct-value
    counts and distributed prefix sums, so no group is ever held in one task. ``max_groups`` bounds
    the number of groups; without it they are counted (one job).
    """
    g = list(group_cols)
    base = df.where(F.col(value_col).isNotNull() & ~F.isnan(F.col(value_col)))
    base = base.select(*_grp(g), F.col(value_col).cast("double").alias("_v"), F.lit(1).alias("_n"))
    if g and max_groups is None:
        max_groups = rows_up_to(base.select(*_grp(g)).distinct())
    cum = cumulative(base, g, "_v", ["_n"], buckets=buckets, max_groups=max_groups)
    n = base.groupBy(*_grp(g)).agg(F.count(F.lit(1)).alias("_cnt"))
    return quantiles_from_prefix(cum, n, g, "_v", "_n", "cum__n", "_cnt", probs, max_groups)
