"""Mixing sources to target weights by weighted fair queueing (operator 11).

Built-in DataFrame functions only. Every source has a weight; the token budget (a share of all
tokens) is split by weight, no target exceeding ``epochs`` times its source, and what such sources
leave goes to the others by weight (water-filling). Documents are shuffled within their source by a
seeded hash; a document's virtual finish time is the tokens its source has sent up to and with it,
earlier epochs included, divided by the source's target. The documents of all sources and epochs,
sorted by finish time, are the mix; it ends where the budget is spent.

Water level. With caps ``C_i`` and weights ``w_i`` the targets are ``min(C_i, level * w_i)``. For any
set K of sources the level is at least ``(budget - sum of C over K) / (sum of w outside K)``, and
equal for the set that is capped, a prefix in the order of ``C_i / w_i``: the level is the largest
of these quotients over the prefixes.

Scale. Only narrow rows are shuffled, never texts. Running totals come from a range sort: rows go
to sampled ranges of their order, each range adds up its own, and one total per range gives the
offsets. So no task holds a whole source, and a hot source spreads over many ranges. Equal rows
are counted first and numbered in chunks, so that they spread too.

Defined results: a null text has no words; null sources are one source, last in order; a null
``doc_id`` is hashed as the empty string; repeated rows are documents of their own, and which of
them takes the part of which is open, since nothing tells them apart; documents without words are
never taken into account (taken 0); a source without words has the target 0; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyrisk.llm.common import materialize

WEIGHTS = (5, 2, 1)      # of the sources in code-point order, repeating
EPOCHS = 3               # times a document may be taken
SHARE = 1.0              # the budget, as a share of all tokens
SEED = 42
RANGE_ROWS = 1_000_000   # rows of a range of the global sort
CHUNK = 4096             # equal rows numbered at once
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(seed: int, *parts: Column) -> Column:
    """60 bits of the MD5 of the parts: a shuffle that other engines can repeat."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def running_totals(df: DataFrame, order: list[Column], sums: list[str], name: str, ranges: int) -> DataFrame:
    """``df`` with ``before_x``, the sum of x over all rows that come earlier in ``order``."""
    rows = materialize(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), name)
    totals = rows.groupBy("_range").agg(*[F.sum(x).alias(f"_sum_{x}") for x in sums])
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)   # one row per range
    offsets = totals.select("_range", *[
        F.coalesce(F.sum(f"_sum_{x}").over(earlier), F.lit(0)).alias(f"_off_{x}") for x in sums])
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = rows.join(F.broadcast(offsets), "_range")
    return out.select(*df.columns, *[
        (F.coalesce(F.sum(x).over(inside), F.lit(0)) + F.col(f"_off_{x}")).alias(f"before_{x}") for x in sums])


def numbered_documents(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size, copy (0.. within equal rows), h of every row of ``docs``."""
    base = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    equal = base.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    parts = equal.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {CHUNK}L"))))
    parts = parts.repartition("part", "doc_id", "source", "size")
    first = F.col("part") * CHUNK
    last = F.least(F.col("n"), first + CHUNK) - 1
    rows = parts.select("doc_id", "source", "size", F.explode(F.sequence(first, last)).alias("copy"))
    return rows.withColumn("h", shuffle_key(seed, F.col("doc_id"), F.col("size"), F.col("copy")))


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS,
                   share: float = SHARE) -> DataFrame:
    """source, place (its number in code-point order), source_size, source_before (tokens of earlier
    sources), weight, target, budget of every source."""
    sources = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                     F.count(F.lit(1)).alias("n_docs")), "mix-sources")
    totals = sources.agg(F.sum("source_size").alias("all_size"), F.count(F.lit(1)).alias("n")).first()
    ranges = 1 + totals["n"] // RANGE_ROWS
    budget = int((totals["all_size"] or 0) * share)
    one = sources.withColumn("one", F.lit(1).cast("long"))
    placed = running_totals(one, [F.col("source").isNull(), F.col("source")], ["one", "source_size"],
                            "mix-places", ranges)
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    weight = F.element_at(cycle, (F.pmod("before_one", F.lit(len(weights))) + 1).cast("int"))
    placed = placed.select("source", "source_size", "n_docs", F.col("before_one").alias("place"),
                           F.col("before_source_size").alias("source_before"), weight.alias("weight"),
                           (F.lit(epochs) * F.col("source_size")).alias("cap"))
    filled = running_totals(placed, [F.col("cap") / F.col("weight"), F.col("place")], ["cap", "weight"],
                            "mix-levels", ranges)
    filled = materialize(filled, "mix-filled")
    all_weight = filled.agg(F.sum("weight")).first()[0] or 0
    quotient = (F.lit(budget) - F.col("before_cap")) / (F.lit(all_weight) - F.col("before_weight"))
    level = filled.agg(F.max(quotient)).first()[0] or 0.0
    target = F.least(F.col("cap").cast("double"), F.lit(float(level)) * F.col("weight"))
    return filled.select("source", "place", "source_size", "n_docs", "source_before", "weight",
                         target.alias("target"), F.lit(budget).cast("long").alias("budget"))


def queue(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, share: float = SHARE,
          seed: int = SEED) -> DataFrame:
    """One row per document and epoch it is offered in: doc_id, source, size, copy, source_size, target,
    epoch, finish (virtual time), before_size (tokens of the mix before it), taken (in the mix or not)."""
    spark = docs.sparkSession
    rows = materialize(numbered_documents(docs, seed), "mix-rows")
    targets = source_targets(rows, weights, epochs, share)
    total = targets.agg(F.sum("n_docs")).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE_ROWS)
    targets = targets.withColumnRenamed("source", "_source")
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "n_docs", "weight")
    shuffled = [F.col(c) for c in ("place", "h", "doc_id", "size", "copy")]
    sent = running_totals(rows, shuffled, ["size"], "mix-sent", ranges)
    sent = sent.withColumn("sent", F.col("before_size") - F.col("source_before") + F.col("size")).drop(
        "before_size", "source_before")
    offered = F.when(F.col("source_size") > 0,
                     F.least(F.lit(epochs), F.floor(F.col("target") / F.col("source_size")) + 1)).otherwise(1)
    offers = sent.withColumn("epoch", F.explode(F.sequence(F.lit(1), offered.cast("int"))))
    finish = ((F.col("epoch") - 1) * F.col("source_size") + F.col("sent")).cast("double") / F.col("target")
    finish = F.when(F.col("target") > 0, finish).otherwise(F.lit(float("inf")))
    offers = offers.withColumn("finish", finish).drop("sent")
    mix = running_totals(offers, [F.col("finish"), *shuffled, F.col("epoch")], ["size"], "mix-queue", ranges)
    return mix.withColumn("taken", F.col("before_size") + F.col("size") <= F.col("budget"))


def mix_report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, share: float = SHARE,
               seed: int = SEED) -> DataFrame:
    """doc_id, source, size, copy, source_size, target, taken (words of it in the mix), times."""
    mix = queue(docs, weights, epochs, share, seed)
    keys = ["doc_id", "source", "size", "copy"]
    times = F.sum(F.col("taken").cast("int"))
    return mix.groupBy(*keys).agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"),
                                  (times * F.col("size")).alias("taken"), times.alias("times"))


def write_mix(docs: DataFrame, path: str, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS,
              share: float = SHARE, seed: int = SEED) -> None:
    """Write the documents of the mix as Parquet, in its order, each as often as it is taken."""
    mix = queue(docs, weights, epochs, share, seed).filter("taken").select(
        F.struct("doc_id", "source", "size", "copy").alias("mix_key"), "finish", "epoch", "before_size")
    equal = W.partitionBy("doc_id", "source", word_count(F.col("text"))).orderBy("text")
    row = F.struct(*[f"`{c}`" for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.struct(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        (F.row_number().over(equal) - 1).cast("long").alias("copy")).alias("doc_key"))
    out = keyed.join(mix, F.col("doc_key").eqNullSafe(F.col("mix_key")))
    order = ["finish", "before_size", "epoch"]
    out.repartitionByRange(*order).sortWithinPartitions(*order).select("row.*").write.parquet(path)
