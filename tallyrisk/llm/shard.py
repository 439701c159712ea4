"""Proportional stratified interleaving into shards (operator 6).

Rows are shuffled by a seeded hash and ranked within their source; the fractional rank
``(rank - 1/2) / rows of the source`` spreads every source evenly over [0, 1), so cutting the
global order by it into equal runs gives every shard the mixture of the whole. Both ranks are
computed without a task holding a whole source: rows go to hash (then fraction) ranges of about
``range_rows`` rows, whose counts give each range its offset. Texts are never shuffled.

Law ``rows``: shard sizes differ by one row at most. Defined results: a null text has size 1 and
the checksum of the empty text; null sources are a source of their own; a null ``doc_id`` is
hashed as null; equal texts are free to part; repeated rows take neighbouring ranks, in any
order, since nothing tells them apart; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyrisk.llm.common import materialize

SHARDS = 16
SEED = 42
RANGE_ROWS = 50_000


def _offsets(counts: DataFrame, part: list[str], order: str) -> DataFrame:
    """counts (part, order, n) with the rows before each range; as many rows as ranges."""
    w = W.partitionBy(*part).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long"))


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
               range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, source, size, text_crc32, pos (global position), shard, slot of every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", "source", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    base = materialize(base.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")), "shard-rows")
    total = base.count()
    if not total:
        return base.drop("h").withColumns({"pos": F.lit(0).cast("long"), "shard": F.lit(0),
                                           "slot": F.lit(0).cast("long")})
    # At least a few ranges per shuffle partition, so that a hot source spreads over all of them.
    width = max(64, min(range_rows, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    source = F.col("source").eqNullSafe(F.col("_s"))
    sizes = base.groupBy(F.col("source").alias("_s")).agg(F.count("*").alias("n_source"))
    ranges = F.ceil(F.col("n_source") / width)
    unit = F.col("h").cast("double") / float(1 << 64) + 0.5
    rows = base.join(sizes, source).drop("_s").withColumn(
        "r", F.least(F.floor(unit * ranges), ranges - 1).cast("long"))
    counts = _offsets(rows.groupBy(F.col("source").alias("_s"), F.col("r").alias("_r")).agg(F.count("*").alias("n")),
                      ["_s"], "_r")
    inside = W.partitionBy("source", "r").orderBy("h", "doc_id", "text_crc32", "size")
    rows = rows.withColumn("k", F.row_number().over(inside))
    rows = rows.join(counts, source & (F.col("r") == F.col("_r"))).drop("_s", "_r")
    rank = F.col("before") + F.col("k")
    slices = -(-total // width)
    fraction = (2 * rank - 1).cast("double") / (2 * F.col("n_source")).cast("double")
    rows = rows.withColumn("fraction", fraction).withColumn(
        "r", F.least(F.floor(F.col("fraction") * slices), F.lit(slices - 1)).cast("long"))
    rows = materialize(rows.select("doc_id", "source", "size", "text_crc32", "h", "fraction", "r"), "shard-ranks")
    counts = _offsets(rows.groupBy(F.col("r").alias("_r")).agg(F.count("*").alias("n")), [], "_r")
    inside = W.partitionBy("r").orderBy("fraction", "source", "h", "doc_id", "text_crc32", "size")
    pos = (F.col("before") + F.col("k") - 1)
    rows = rows.withColumn("k", F.row_number().over(inside)).join(counts, F.col("r") == F.col("_r"))
    rows = rows.withColumn("pos", pos)
    shard = F.expr(f"pos * {shards} div {total}")
    return rows.withColumn("shard", shard.cast("int")).select(
        "doc_id", "source", "size", "text_crc32", "pos", "shard",
        (F.col("pos") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write ``docs`` as Parquet under ``path/shard=k``, each shard in slot order per file; ``docs`` must not have
    columns ``shard`` and ``slot``."""
    names = docs.columns
    if {"shard", "slot"} & {c.lower() for c in names}:
        raise ValueError("columns shard and slot would be replaced by the output")
    docs = docs.toDF(*[c if c in ("doc_id", "text", "source") else f"other column {i}" for i, c in enumerate(names)])
    placed = interleave(docs, shards, seed).select(
        F.col("doc_id").alias("_d"), F.col("text_crc32").alias("_c"), F.col("size").alias("_z"), "shard", "slot")
    text = F.coalesce(F.col("text"), F.lit(""))
    # A repeated row pairs with its own places: both sides are numbered within equal rows.
    same = W.partitionBy("_d", "_c", "_z").orderBy("shard", "slot")
    placed = placed.withColumn("_n", F.row_number().over(same))
    keyed = docs.withColumns({"_kd": F.col("doc_id"), "_kc": F.crc32(F.encode(text, "UTF-8")),
                              "_kz": (F.octet_length(text) + F.lit(1)).cast("long")})
    keyed = keyed.withColumn("_kn", F.row_number().over(W.partitionBy("_kd", "_kc", "_kz").orderBy("source")))
    out = keyed.join(placed, F.col("_kd").eqNullSafe(F.col("_d")) & (F.col("_kc") == F.col("_c"))
                     & (F.col("_kz") == F.col("_z")) & (F.col("_kn") == F.col("_n")))
    out = out.drop("_d", "_c", "_z", "_n", "_kd", "_kc", "_kz", "_kn").toDF(*names, "shard", "slot")
    (out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
