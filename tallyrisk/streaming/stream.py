"""Structured Streaming re-aims of batch operators (X-1..X-4).

The reference has no streams; its scheduled monitor and repeated ingestion are
the continuous needs. Each job here reuses a batch operator on a file stream,
keeps its progress in a checkpoint under the shared checkpoint folder (so a
restarted or re-triggered job resumes, and already-ingested files are never
re-read), and writes to Parquet. ``trigger(availableNow=True)`` processes what
has landed and stops, which is how a scheduler would run it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import coerce_types, normalize_blanks
from ..operators.drift import bin_index
from ..operators.policy import decide
from ..operators.validate import ORIGINATION_RULES, validate
from ..sources.tape import ORIGINATION_COLUMNS, ORIGINATION_TYPES, TAPE_OPTIONS, quarter_of, string_schema


def run_available_now(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                      partition_by: list[str] | None = None) -> DataFrame:
    """Run a streaming frame over everything available into a Parquet sink; return the sink."""
    w = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start(sink)
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()
    return stream.sparkSession.read.parquet(sink)


def land_files(rows: DataFrame, folder: str, least: int = 4, batches: int = 2) -> int:
    """Write ``rows`` as the files of a stream, one for each of their partitions (so that every task writes its own
    and none are shuffled), ``least`` at least; returns the files a trigger takes to read them in ``batches``."""
    n = rows.rdd.getNumPartitions()
    if n < least:
        rows, n = rows.repartition(least), least
    rows.write.parquet(folder)
    return -(-n // batches)


END = "__end__"   # event type of the end-of-stream marker


def event_stream(spark: SparkSession, folder: str, schema, glob: str | None = None,
                 end_folder: str | None = None, max_files: int | None = None) -> DataFrame:
    """Event file stream over a folder (optionally only files matching ``glob``); event time
    as TIMESTAMP (watermarks need it; the session is UTC).

    A window is emitted once the watermark has passed its end, so a stream that simply stops
    keeps its last windows. ``end_folder`` is a second folder, where ``write_end_marker`` puts one
    row far behind the last event: it moves the watermark past every window and is counted in none.
    """
    def read(path: str, pattern: str | None) -> DataFrame:
        r = spark.readStream.schema(schema)
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        if pattern:
            r = r.option("pathGlobFilter", pattern)
        return r.parquet(path)
    s = read(folder, glob)
    if end_folder:
        s = s.unionByName(read(end_folder, None))
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def write_end_marker(events: DataFrame, end_folder: str, days: int = 366) -> None:
    """One marker row ``days`` behind the last of ``events`` (the batch frame), in their schema."""
    last = events.agg((F.max("ts") + F.make_dt_interval(F.lit(days))).alias("ts"))
    cols = {"ts": F.col("ts"), "event_type": F.lit(END)}
    last.select(*[cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema.fields]
                ).write.mode("overwrite").parquet(end_folder)


def stream_delinquency_rate(events: DataFrame, window: str = "1 day", slide: str | None = None,
                            watermark: str = "1 hour", bad_type: str = "error") -> DataFrame:
    """X-1 (A-2 on a stream): per event-time window the number of events, bad events and
    their rate; rows later than the watermark are dropped; windows are final when emitted."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    real = F.coalesce(F.col("event_type") != END, F.lit(True))
    agg = (events.withWatermark("ts", watermark).groupBy(w.alias("w"))
           .agg(F.count_if(real).alias("n_events"),
                F.sum((F.col("event_type") == bad_type).cast("long")).alias("n_bad")).where("n_events > 0"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "n_events", "n_bad", (F.col("n_bad") / F.col("n_events")).alias("rate"))


def stream_bin_counts(events: DataFrame, edges: list[float], value_col: str = "value",
                      window: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    """X-2, streaming half: counts per (window, bin) against *frozen* reference edges
    (a literal array: a few numbers, shipped with the plan)."""
    e = F.array(*[F.lit(float(x)) for x in edges])
    b = bin_index(F.col(value_col).cast("double"), e, len(edges))
    # Nulls are left out of the counts, not filtered before the watermark: the end marker has none.
    agg = (events.withWatermark("ts", watermark)
           .groupBy(F.window("ts", window).alias("w"), b.alias("bin"))
           .agg(F.count(value_col).alias("n")).where("n > 0"))
    return agg.select(F.col("w.start").alias("window_start"), "bin", "n")


def psi_by_window(counts: DataFrame, ref_props: DataFrame, n_bins: int, eps: float = 1e-8) -> DataFrame:
    """X-2, per-window PSI from the sink's (window, bin, n) rows and the reference shares
    ``(bin, ref_share)``; every window gets the full bin list (a literal sequence)."""
    inr = counts.where(F.col("bin").isNotNull())
    tot = inr.groupBy("window_start").agg(F.sum("n").alias("ct"))
    grid = tot.select("window_start", "ct", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    g = grid.join(inr, ["window_start", "bin"], "left").join(F.broadcast(ref_props), "bin", "left")
    c = F.greatest(F.coalesce(F.col("n"), F.lit(0)) / F.col("ct"), F.lit(eps))
    r = F.greatest(F.coalesce(F.col("ref_share"), F.lit(0.0)), F.lit(eps))
    return g.groupBy("window_start").agg(F.sum((c - r) * F.ln(c / r)).alias("psi"),
                                         F.max("ct").alias("n_in_range"))


def write_feature_psi(events: DataFrame, edges: dict[str, list[float]], ref_shares: DataFrame, sink: str,
                      checkpoint: str, window: str = "1 day") -> DataFrame:
    """X-2 for many features, by ``foreachBatch``: (window, feature, bin) counts against frozen reference edges and
    the PSI of every window a batch has touched. ``ref_shares``: (feature, bin, ref_share).

    Idempotent: a batch writes its own counts to ``counts/batch=<id>`` and its PSI to ``psi/batch=<id>``, replacing
    what an earlier attempt at the same batch left, so a replay changes nothing. PSI is taken from the sums over
    all batches up to this one; the row of the latest batch holds. Late rows count in their own window.
    """
    features = sorted(edges)

    def entry(name: str):
        value, ends = F.col(name).cast("double"), F.array(*[F.lit(float(x)) for x in edges[name]])
        return F.struct(F.lit(name).alias("feature"), value.alias("value"), bin_index(value, ends, len(edges[name])).alias("bin"))

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        long = batch.select(F.window("ts", window).getField("start").alias("window_start"),
                            F.inline(F.array(*[entry(f) for f in features])))
        counts = (long.where(F.col("value").isNotNull() & ~F.isnan("value") & F.col("window_start").isNotNull())
                  .groupBy("window_start", "feature", "bin").agg(F.count(F.lit(1)).alias("n")))
        counts.write.mode("overwrite").parquet(f"{sink}/counts/batch={batch_id}")
        every = spark.read.schema("window_start timestamp, feature string, bin int, n long, batch long").option(
            "basePath", f"{sink}/counts").parquet(f"{sink}/counts").where(F.col("batch") <= batch_id)
        touched = every.where(F.col("batch") == batch_id).select("window_start", "feature").distinct()
        sums = every.join(touched, ["window_start", "feature"], "left_semi").groupBy(
            "window_start", "feature", "bin").agg(F.sum("n").alias("n"))
        psi_by_feature(sums, ref_shares, edges).write.mode("overwrite").parquet(f"{sink}/psi/batch={batch_id}")

    q = (events.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_feature_psi(events.sparkSession, sink)


def read_feature_psi(spark: SparkSession, sink: str) -> DataFrame:
    """(window_start, feature, psi, n_in_range, out_of_range): the latest of each window and feature."""
    rows = spark.read.option("basePath", f"{sink}/psi").schema(
        "window_start timestamp, feature string, psi double, n_in_range long, out_of_range long, batch long"
    ).parquet(f"{sink}/psi")
    values = ["psi", "n_in_range", "out_of_range"]
    return rows.groupBy("window_start", "feature").agg(F.max_by(F.struct(*values), "batch").alias("r")).select(
        "window_start", "feature", *[F.col(f"r.{v}").alias(v) for v in values])


def psi_by_feature(counts: DataFrame, ref_shares: DataFrame, edges: dict[str, list[float]],
                   eps: float = 1e-8) -> DataFrame:
    """M-3 per window and feature from (window_start, feature, bin, n); NULL where nothing is in range."""
    last = F.create_map(*[x for f, e in edges.items() for x in (F.lit(f), F.lit(max(len(e) - 2, 0)))])
    inside = F.col("bin").isNotNull()
    tot = counts.groupBy("window_start", "feature").agg(
        F.coalesce(F.sum(F.when(inside, F.col("n"))), F.lit(0)).alias("ct"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("out"))
    grid = tot.select("*", F.explode(F.sequence(F.lit(0), F.element_at(last, F.col("feature")))).alias("bin"))
    g = grid.join(counts.where(inside), ["window_start", "feature", "bin"], "left").join(
        ref_shares.select("feature", "bin", "ref_share"), ["feature", "bin"], "left")
    c = F.greatest(F.try_divide(F.coalesce(F.col("n"), F.lit(0)), F.col("ct")), F.lit(eps))
    r = F.greatest(F.coalesce(F.col("ref_share"), F.lit(0.0)), F.lit(eps))
    return g.groupBy("window_start", "feature").agg(
        F.sum(F.when(F.col("ct") > 0, (c - r) * F.ln(c / r))).alias("psi"),
        F.max("ct").alias("n_in_range"), F.max("out").alias("out_of_range"))


def stream_tape_ingest(spark: SparkSession, landing: str, sink: str, checkpoint: str) -> DataFrame:
    """X-3 (S-2 on a stream): newly landed tape files → typed, validated Parquet by quarter.
    The stream checkpoint records ingested files, replacing the reference's exists-check."""
    raw = (spark.readStream.options(**TAPE_OPTIONS).schema(string_schema(ORIGINATION_COLUMNS))
           .option("recursiveFileLookup", "true").csv(landing))
    raw = raw.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_name").alias("_file_name"))
    raw = raw.withColumn("quarter", quarter_of())
    clean = normalize_blanks(raw.drop("_file", "_file_name"))
    typed = coerce_types(validate(clean, ORIGINATION_RULES), ORIGINATION_TYPES)
    return run_available_now(typed, sink, checkpoint, "append", ["quarter"])


def stream_score(scores: DataFrame, approve: float = 0.10, decline: float = 0.25) -> DataFrame:
    """X-4 (P-12 without capacity — stateless): decision per scored record."""
    return scores.select("*", decide(F.col("pd"), approve, decline).alias("decision"))
