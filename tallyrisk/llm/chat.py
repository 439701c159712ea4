"""Multi-party perspective rotation of dialogues (operator 3).

For every participant of a conversation the dialogue is rendered with that speaker as
``assistant`` and every other speaker as a named user; the mask lists the spans (code points,
start inclusive, end exclusive) of the assistant's own words and closing marks, the parts to
train on. Turns of a system role stay system turns and take no perspective.

Every rendering comes in parts: the rows of a conversation are numbered in order, and part p holds
the rows from p * ``part_turns`` on, so a conversation that holds a large share of all rows spreads
over many tasks and rows. The parts of a perspective, joined by ``part``, are the whole dialogue, and
masks count from its start. Defined results: null texts are empty, null
roles are the speaker "unknown", null turns come first; rows of one turn are ordered by role and
text, repeated rows are rendered as often as they occur; a null ``conv_id`` is a conversation of
its own; a conversation of system turns alone has no perspective; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrisk.llm.common import materialize

SYSTEM = ("system",)
PART_TURNS = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"    # fixed values: the published chat markup


def _positions(rows: DataFrame, part_turns: int) -> DataFrame:
    """Rows of long conversations with the part they fall into and how often they occur there: a
    range sort over all of them, with offsets per conversation and range."""
    order = ["turn", "role", "text"]
    ranges = rows.groupBy("conv_id", "key", *order).agg(F.count("*").alias("n")).repartitionByRange("key", *order)
    ranges = materialize(ranges.withColumn("range", F.spark_partition_id()), "turns")
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("key", "range").agg(F.sum("n").alias("n")).select(
        "key", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("key", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.join(offsets, ["key", "range"]).withColumn(
        "at", F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    last = F.floor((F.col("at") + F.col("n") - 1) / part_turns)
    placed = placed.withColumn("part", F.explode(F.sequence(F.floor(F.col("at") / part_turns), last)))
    copies = (F.least(F.col("at") + F.col("n"), (F.col("part") + 1) * part_turns)
              - F.greatest(F.col("at"), F.col("part") * part_turns))
    return placed.select("conv_id", "key", F.col("part").cast("int").alias("part"), *order,
                         copies.cast("int").alias("copies"))


def _gather(rows: DataFrame) -> DataFrame:
    """One row per conversation and part, with its turns in order."""
    parts = rows.groupBy("conv_id", "key", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "copies"))).alias("turns"))
    return parts.withColumn("turns", F.flatten(F.transform("turns", lambda t: F.array_repeat(t, t["copies"]))))


def rotate(turns: DataFrame, system_roles: tuple[str, ...] = SYSTEM, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, perspective, part, n_turns, rendered, mask (array of {start, end})."""
    rows = turns.select(
        "conv_id", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        F.coalesce(F.col("turn"), F.lit(-1)).cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    speakers = (rows.filter(~F.col("role").isin(*system_roles)).select("key", F.col("role").alias("perspective"))
                .distinct())
    long = (rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > part_turns)
            .select("key", F.lit(True).alias("long")))
    rows = rows.join(long, "key", "left")
    short = _gather(rows.filter(F.col("long").isNull()).withColumns({"part": F.lit(0), "copies": F.lit(1)}))
    short = short.join(speakers, "key").withColumn("at", F.lit(0).cast("long"))
    cut = materialize(_gather(_positions(rows.filter("long"), part_turns)), "parts")
    cut = cut.join(speakers, "key")
    size = F.length(_rendered(system_roles)).cast("long")
    # One narrow row per part and perspective: part_turns times fewer than the conversation has rows.
    earlier = Window.partitionBy("key", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.select("key", "perspective", "part", F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias("at"))
    return _render(short.unionByName(cut.join(starts, ["key", "perspective", "part"])), system_roles)


def _pieces(system_roles: tuple[str, ...]):
    mine = lambda t: t["role"] == F.col("perspective")

    def head(t):
        speaker = F.when(mine(t), F.lit("assistant")).when(
            t["role"].isin(*system_roles), t["role"]).otherwise(F.concat(F.lit("user name="), t["role"]))
        return F.concat(F.lit(OPEN), speaker, F.lit("\n"))
    pieces = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("body"), mine(t).alias("own")))
    return pieces


def _rendered(system_roles: tuple[str, ...]):
    return F.array_join(F.transform(_pieces(system_roles), lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")


def _render(each: DataFrame, system_roles: tuple[str, ...]) -> DataFrame:
    each = each.withColumn("pieces", _pieces(system_roles))
    rendered = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")
    spans = F.aggregate(
        "pieces", F.struct(F.col("at").cast("long").alias("at"),
                           F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p["head"]) + F.length(p["body"]) + 1).cast("long").alias("at"),
            F.when(p["own"], F.concat(s["spans"], F.array(F.struct(
                (s["at"] + F.length(p["head"])).cast("long").alias("start"),
                (s["at"] + F.length(p["head"]) + F.length(p["body"])).cast("long").alias("end")))))
            .otherwise(s["spans"]).alias("spans")), lambda s: s["spans"])
    return each.select("conv_id", "perspective", "part", F.size("pieces").cast("long").alias("n_turns"),
                       rendered.alias("rendered"), spans.alias("mask"))
