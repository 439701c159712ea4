"""Generic sources and sinks: keyed CSV / Parquet sources, feature and label datasets,
file lineage, JSON and text report sinks (S-7, S-8, S-12..S-17)."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

LINEAGE_BLOCK = 64 << 20    # bytes hashed by one task
READ_BYTES = 4 << 20        # bytes of a file in memory at a time


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system has ``path`` (an unreadable one is there, and fails when read)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """S-7: header CSV; types inferred unless a schema is given (give one at scale)."""
    r = spark.read.option("header", "true")
    # Explicit patterns keep partial dates such as '1998-10' as text, as a plain CSV reader does.
    r = r.schema(schema) if schema is not None else r.options(
        inferSchema="true", dateFormat="yyyy-MM-dd", timestampFormat="yyyy-MM-dd HH:mm:ss")
    return r.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


SOURCE_READERS = {"csv": read_csv, "parquet": read_parquet}


def load_source(spark: SparkSession, source: str) -> DataFrame:
    """S-7: ``csv:<path>`` / ``parquet:<path>``; unknown key → ValueError, missing → FileNotFoundError."""
    kind, _, path = source.partition(":")
    if kind not in SOURCE_READERS or not path:
        raise ValueError(f"unknown source {source!r}; expected one of {sorted(SOURCE_READERS)}")
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return SOURCE_READERS[kind](spark, path)


def union_quarters(spark: SparkSession, paths: list[str]) -> DataFrame:
    """S-12 / U-1: all quarter outputs as one frame; columns missing in some files are NULL;
    no cross-quarter de-duplication."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """S-13: feature / label frames → Parquet (overwrite)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def label_dataset(spark: SparkSession, input_path: str, output_path: str, **label_kw) -> DataFrame:
    """S-14: CSV or Parquet by extension → forward default label (J-1) → Parquet."""
    from ..operators.labels import forward_default_label

    if input_path.rstrip("/").lower().endswith(".csv"):
        panel = read_csv(spark, input_path)
    else:
        panel = read_parquet(spark, input_path)
    date_col = label_kw.get("date_col", "reporting_month")
    if date_col in panel.columns and dict(panel.dtypes)[date_col] == "string":
        panel = panel.withColumn(date_col, F.to_date(date_col))
    labeled = forward_default_label(panel, **label_kw)
    write_parquet(labeled, output_path)
    return read_parquet(spark, output_path)


def _listed(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    """path, size_bytes of the input files that are not empty (file sources skip those); contents are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", F.col("length").alias("size_bytes"))


def _open(path: str):
    """A file of any file system, for reads at a position."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[len("file:"):].lstrip("/"))
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _digest(path: str, start: int, size: int) -> bytes:
    """SHA-256 of a byte range, read a few MB at a time. A file that ends early is an error."""
    h = hashlib.sha256()
    with _open(path) as f:
        while size:
            piece = f.read_at(min(size, READ_BYTES), start)
            if not piece:
                raise EOFError(f"{path} ends at byte {start}")
            h.update(piece)
            start, size = start + len(piece), size - len(piece)
    return h.digest()


def _with_digest(ranges: DataFrame) -> DataFrame:
    """``digest`` of each row's byte range (path, start, size): one range after the other, in tasks."""
    schema = ranges.withColumn("digest", F.lit(b"")).schema

    def run(batches):
        for batch in batches:
            digests = [_digest(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "size")))]
            yield batch.append_column("digest", pa.array(digests, pa.binary()))
    ship_package(ranges.sparkSession)
    return ranges.mapInArrow(run, schema)


def file_lineage(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """S-15: per input file its path, size and SHA-256 of the content.

    SHA-256 runs from the first byte to the last, so one task reads a file, in pieces of ``READ_BYTES``:
    files have no size limit, and memory does not depend on them. ``file_lineage_tree`` spreads large files.
    """
    files = _listed(spark, path, glob).withColumns({"start": F.lit(0).cast("long"), "size": F.col("size_bytes")})
    return _with_digest(files.repartition("path")).select("path", "size_bytes", F.lower(F.hex("digest")).alias("sha256"))


def file_lineage_tree(spark: SparkSession, path: str, glob: str | None = None,
                      block_bytes: int = LINEAGE_BLOCK) -> DataFrame:
    """S-15 for files of any size: path, size_bytes, n_blocks, root_sha256 (hex).

    Each file is cut into blocks of ``block_bytes`` that are hashed by different tasks; the root is the SHA-256
    of the block digests in file order (32 bytes a block: 16 MB for a file of 32 TB in default blocks). Roots
    compare between runs of the same ``block_bytes`` only. Empty files have no row.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.col("size_bytes") - 1, F.lit(block_bytes).cast("long"))
    blocks = _listed(spark, path, glob).select("path", "size_bytes", F.explode(starts).alias("start"))
    blocks = blocks.withColumn("size", F.least(F.lit(block_bytes).cast("long"), F.col("size_bytes") - F.col("start")))
    hashed = _with_digest(blocks.repartition("path", "start"))
    leaves = F.transform(F.sort_array(F.collect_list(F.struct("start", "digest"))), lambda b: F.hex(b["digest"]))
    return hashed.groupBy("path", "size_bytes").agg(leaves.alias("leaves")).select(
        "path", "size_bytes", F.size("leaves").alias("n_blocks"),
        F.sha2(F.unhex(F.array_join("leaves", "")), 256).alias("root_sha256"))


def write_json_report(df: DataFrame, path: str) -> DataFrame:
    """S-16: result frame → JSON lines (one file: report frames are small by construction)."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def _markdown_table(rows: DataFrame, columns: list[str], title: str) -> DataFrame:
    """A frame of bounded size as a titled Markdown table, in the order of its first column; one row."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(columns[0]).alias("k"), line.alias("line")))),
                        lambda r: r["line"])
    head = ["", f"## {title}", "", "| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    return rows.agg(F.concat_ws("\n", *[F.lit(h) for h in head], lines).alias("text"))


def summary_markdown(report: DataFrame, title: str = "Monitoring summary", score: DataFrame | None = None,
                     rolling: DataFrame | None = None, policy_version: str | None = None) -> DataFrame:
    """S-17: the consolidated monitoring report (M-11) rendered as one Markdown text row, with the percentiles of
    both sides (``score``: the row of ``score_drift``), the AUC of each window (``rolling``: ``rolling_auc``, a row
    per period) and the policy version where they are given. The report (a row per statistic) is found once and
    stored, as it is read twice."""
    report = report.checkpoint(eager=True)
    lines = report.select(F.format_string(
        "| %s | %s | %s | %.6f | %s |", "check", "name", "metric",
        F.coalesce(F.col("value"), F.lit(float("nan"))), "severity").alias("line"),
        "check", "name", "metric")
    alerts = report.where(F.col("severity") == "alert").select("check", "name").distinct()
    body = lines.agg(F.array_join(F.array_sort(F.collect_list(F.struct("check", "name", "metric", "line")))
                                  .getField("line"), "\n").alias("table"))
    al = alerts.agg(F.count(F.lit(1)).alias("n_alert"),
                    F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "check", "name"))), ", ")
                    .alias("alert_list"))
    from ..operators.ranking import attach

    j = attach(body, al)
    status = F.when(F.col("n_alert") > 0, "ALERT").otherwise("OK")
    text = F.concat_ws("\n", F.lit(f"# {title}"), F.lit(""),
                       F.concat(F.lit("Status: **"), status, F.lit("**")),
                       F.concat(F.lit("Alerts: "), F.coalesce(F.nullif(F.col("alert_list"), F.lit("")), F.lit("none"))),
                       F.lit(""), F.lit("| check | name | metric | value | severity |"),
                       F.lit("|---|---|---|---|---|"), F.col("table"))
    if policy_version is not None:
        text = F.concat_ws("\n", text, F.lit(""), F.lit(f"Policy version: {policy_version}"))
    out = j.select(text.alias("markdown"))
    extra = []
    if score is not None:
        pcts = sorted(int(c[5:]) for c in score.columns if c.startswith("ref_p"))
        rows = score.select(F.inline(F.array(*[F.struct(
            F.lit(p).alias("percentile"), F.col(f"ref_p{p}").alias("reference"), F.col(f"cur_p{p}").alias("current"))
            for p in pcts])))
        extra.append(_markdown_table(rows, ["percentile", "reference", "current"], "Score percentiles"))
    if rolling is not None:
        rows = rolling.select("period", F.round("auc", 6).alias("auc"), "n_obs", "n_defaults")
        extra.append(_markdown_table(rows, ["period", "auc", "n_obs", "n_defaults"], "Rolling AUC"))
    for e in extra:
        out = attach(out, e).select(F.concat_ws("\n", "markdown", "text").alias("markdown"))
    return out

