"""Queries: Structured Streaming re-aims (X-1..X-4), each run with ``availableNow`` over
files Spark lands from the driver's tables, into Parquet sinks in the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import drift as D
from ..session import scratch_path
from ..sources import tape as TP
from ..streaming import stream as ST
from . import bindings as B
from .catalog import query
from .oracle_views import with_views
from .q_sources import _NORM


def _frozen(ref, features):
    """Reference edges (at most 11 numbers a feature) and shares (feature, bin, ref_share), fixed before the stream."""
    edges = {r.feature: list(r.edges) for r in D.quantile_edges(ref, features).collect()}
    found = ref.sparkSession.createDataFrame(list(edges.items()), "feature string, edges array<double>")
    hist = D.histogram(D.two_sides(ref, None, features), found)
    share = F.col("rn") / F.sum("rn").over(Window.partitionBy("feature"))    # a row per bin
    return (edges, hist.select("feature", "bin", share.alias("ref_share")).checkpoint(eager=True))


def _events_stream(spark, d):
    ev = B.events(spark, d)
    end = scratch_path(spark, "events-end")
    ST.write_end_marker(ev, end)
    return ST.event_stream(spark, d, ev.schema, "events.parquet", end)


@query("stream_delinquency_rate", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       count(*) AS n_events, count(*) FILTER (WHERE event_type = 'error') AS n_bad,
       count(*) FILTER (WHERE event_type = 'error') / count(*)::DOUBLE AS rate
FROM events GROUP BY 1, 2""")
def q_stream_delinquency_rate(spark, d):
    """X-1: daily event windows with the 'error' rate, watermark 1 hour."""
    s = ST.stream_delinquency_rate(_events_stream(spark, d))
    return ST.run_available_now(s, scratch_path(spark, "x1-sink"), scratch_path(spark, "x1-ckpt"))


@query("stream_psi", """
WITH ref AS (SELECT value::DOUBLE AS v FROM events WHERE ts < TIMESTAMP '2024-01-15' AND value IS NOT NULL),
e AS (SELECT list_sort(list_distinct([quantile_cont(v, 0.0), quantile_cont(v, 0.1), quantile_cont(v, 0.2),
  quantile_cont(v, 0.3), quantile_cont(v, 0.4), quantile_cont(v, 0.5), quantile_cont(v, 0.6), quantile_cont(v, 0.7),
  quantile_cont(v, 0.8), quantile_cont(v, 0.9), quantile_cont(v, 1.0)])) AS edges FROM ref),
b AS (SELECT date_trunc('day', ts) AS w, ts, value::DOUBLE AS v,
             least(len(list_filter(edges, lambda x: x <= value)) - 1, len(edges) - 2) AS bin, edges
      FROM events, e WHERE value IS NOT NULL AND value BETWEEN edges[1] AND edges[-1]),
r AS (SELECT bin, count(*) / (sum(count(*)) OVER ())::DOUBLE AS share FROM b WHERE ts < TIMESTAMP '2024-01-15' GROUP BY bin),
c AS (SELECT w, bin, count(*) AS n FROM b GROUP BY w, bin),
t AS (SELECT w, sum(n) AS ct FROM c GROUP BY w),
g AS (SELECT t.w, ct, greatest(coalesce(n, 0) / ct::DOUBLE, 1e-8) AS p, greatest(coalesce(share, 0), 1e-8) AS q
      FROM t CROSS JOIN (SELECT unnest(range(0, (SELECT len(edges) - 1 FROM e))) AS bin)
      LEFT JOIN c USING (w, bin) LEFT JOIN r USING (bin))
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, sum((p - q) * ln(p / q)) AS psi, max(ct)::BIGINT AS n_in_range
FROM g GROUP BY w""")
def q_stream_psi(spark, d):
    """X-2: PSI of each day's event values against edges frozen from the
    first half of the month."""
    ev = B.events(spark, d)
    ref = ev.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    edges, ref_props = _frozen(ref, ["value"])
    edges = edges["value"]
    counts = ST.stream_bin_counts(_events_stream(spark, d), edges)
    sink = ST.run_available_now(counts, scratch_path(spark, "x2-sink"), scratch_path(spark, "x2-ckpt"))
    return ST.psi_by_window(sink, ref_props, max(len(edges) - 1, 1))


_LINES = "SELECT l_shipdate AS ts, l_quantity, l_extendedprice, l_discount FROM lineitem WHERE l_shipdate IS NOT NULL"
_LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


@query("stream_feature_psi", f"""
WITH t AS ({_LINES}),
v AS ({" UNION ALL ".join(f"SELECT ts, '{f}' AS feature, {f}::DOUBLE AS value FROM t" for f in _LINE_FEATURES)}),
x AS (SELECT * FROM v WHERE value IS NOT NULL),
e AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{", ".join(str(i / 10) for i in range(11))}]))) AS edges
      FROM x WHERE ts < TIMESTAMP '1996-01-01' GROUP BY feature),
b AS (SELECT x.*, len(edges) AS k, CASE WHEN value BETWEEN edges[1] AND edges[-1] THEN
             least(len(list_filter(edges, lambda q: q <= value)) - 1, len(edges) - 2) END AS bin FROM x JOIN e USING (feature)),
r AS (SELECT feature, bin, count(*) / (sum(count(*)) OVER (PARTITION BY feature))::DOUBLE AS share
      FROM b WHERE ts < TIMESTAMP '1996-01-01' AND bin IS NOT NULL GROUP BY feature, bin),
c AS (SELECT epoch(ts)::BIGINT // 86400 // 28 AS w, feature, bin, count(*) AS n FROM b GROUP BY ALL),
s AS (SELECT w, feature, coalesce(sum(n) FILTER (bin IS NOT NULL), 0) AS ct, coalesce(sum(n) FILTER (bin IS NULL), 0) AS out
      FROM c GROUP BY ALL),
g AS (SELECT s.*, greatest(coalesce(c.n, 0) / ct::DOUBLE, 1e-8) AS p, greatest(coalesce(r.share, 0), 1e-8) AS q
      FROM s JOIN (SELECT feature, unnest(range(0, greatest(len(edges) - 1, 1))) AS bin FROM e) USING (feature)
      LEFT JOIN c USING (w, feature, bin) LEFT JOIN r USING (feature, bin))
SELECT strftime(TIMESTAMP '1970-01-01' + INTERVAL 1 DAY * (w * 28), '%Y-%m-%d %H:%M:%S') AS window_start, feature,
       sum(CASE WHEN ct > 0 THEN (p - q) * ln(p / q) END) AS psi, max(ct)::BIGINT AS n_in_range, max(out)::BIGINT AS out_of_range
FROM g GROUP BY w, feature""")
def q_stream_feature_psi(spark, d):
    """X-2 per feature by ``foreachBatch``: PSI of every four weeks of shipped lines against the years before 1996."""
    lines = B.read(spark, d, "lineitem").select(F.col("l_shipdate").cast("timestamp").alias("ts"), *_LINE_FEATURES)
    lines = lines.where("ts is not null")
    ref = lines.where(F.col("ts") < F.lit("1996-01-01").cast("timestamp"))
    edges, shares = _frozen(ref, _LINE_FEATURES)
    landing = scratch_path(spark, "x2-lines")
    per_trigger = ST.land_files(lines, landing)
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", per_trigger).parquet(landing)
    return ST.write_feature_psi(stream, edges, shares, scratch_path(spark, "x2-psi"), scratch_path(spark, "x2-psi-ckpt"),
                                window="28 days")


@query("stream_tape_ingest", with_views("""
SELECT o.loan_sequence_number, o.quarter, o.credit_score, o.orig_upb, CAST(coalesce(nv.n, 0) AS INTEGER) AS n_violations
FROM v_orig o LEFT JOIN nv USING (loan_id)""", "v_orig", extra=_NORM))
def q_stream_tape_ingest(spark, d):
    """X-3 (rows only): landed origination tape → typed Parquet by quarter, resumable."""
    landing = scratch_path(spark, "x3-landing")
    TP.write_tape(B.orig_tape(spark, d), TP.ORIGINATION_COLUMNS, landing, partition_col="quarter")
    out = ST.stream_tape_ingest(spark, landing, scratch_path(spark, "x3-sink"), scratch_path(spark, "x3-ckpt"))
    return out.select("loan_sequence_number", "quarter", "credit_score", "orig_upb",
                      F.size("violations").alias("n_violations"))


@query("stream_score", with_views("""
SELECT id, pd, CASE WHEN pd < 0.10 THEN 'approve' WHEN pd >= 0.25 THEN 'decline' ELSE 'review' END AS decision
FROM v_score""", "v_score"))
def q_stream_score(spark, d):
    """X-4: the stateless decision applied to a stream of scored records."""
    src = scratch_path(spark, "x4-scores")
    s = B.scores(spark, d).select("id", "pd")
    s.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(s.schema).parquet(src)
    out = ST.run_available_now(ST.stream_score(stream), scratch_path(spark, "x4-sink"),
                               scratch_path(spark, "x4-ckpt"))
    return out.select("id", "pd", "decision")
