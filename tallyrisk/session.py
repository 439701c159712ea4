"""SparkSession construction and shared-folder helpers.

Cluster deployments pass their own settings (``spark.checkpoint.dir`` in
particular); the helpers here only fill in what is unset, which is what the
tests and the local bench rely on.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter for correctness (UTC, ANSI) and for scale (AQE with
# skew-join splitting and partition coalescing).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT-compile methods above 8000 bytecode bytes; a fused stage with
    # wide CASE expressions would otherwise run interpreted. Spark's own advice for HotSpot.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster reading ~100 TB (applied by the deployment, not by tests):
# AQE starts from many shuffle partitions and coalesces them to ~256 MB; scans split at
# 256 MB; skewed join partitions above 5x the median (and 512 MB) are split; broadcasts stay
# at the default 10 MB threshold, so only the size-bounded sides named in README qualify.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20,
                           lo: int = 200, hi: int = 200_000) -> int:
    """Shuffle partitions so each holds about ``target_bytes`` of the input (clipped)."""
    return max(lo, min(hi, -(-input_bytes // target_bytes)))


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallyrisk") -> SparkSession:
    """Return the active session, or build one for local runs and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TALLYRISK_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# SQL settings our plans rely on for speed; applied to a caller's session only where the
# session still has Spark's default value (a deliberate user setting is left alone).
_RUNTIME_DEFAULTS = {
    "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
    "spark.sql.adaptive.skewJoin.enabled": ("true", "true"),
    "spark.sql.adaptive.enabled": ("true", "true"),
    # Compressed bytes: rows of these tables take 10 to 30 times as much in a task's sorts and hash maps.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", "8m"),
    "spark.sql.files.maxPartitionBytes": ("134217728b", "32m"),
}
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Stored bytes of the tables per initial shuffle partition: AQE joins small ones, but never cuts large ones.
TABLE_BYTES_PER_PARTITION = 4 << 20


def size_shuffles(spark: SparkSession, sf_dir: str) -> None:
    """Initial shuffle partitions in proportion to the tables, so that no task's share grows with them.

    A caller's own setting stays; ``spark.sql.shuffle.partitions`` is the least number."""
    if not spark.conf.isModifiable(_INITIAL_PARTITIONS):
        return
    own = spark.conf.get(_INITIAL_PARTITIONS, None)
    if own is not None and own != getattr(spark, "_tallyrisk_partitions", None):
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    stored = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark._tallyrisk_partitions = str(shuffle_partitions_for(stored, TABLE_BYTES_PER_PARTITION, lo=least))
    spark.conf.set(_INITIAL_PARTITIONS, spark._tallyrisk_partitions)


def apply_runtime_defaults(spark: SparkSession) -> None:
    for key, (spark_default, ours) in _RUNTIME_DEFAULTS.items():
        try:
            if spark.conf.get(key, spark_default) == spark_default and spark.conf.isModifiable(key):
                spark.conf.set(key, ours)
        except Exception:  # pragma: no cover - read-only or unknown key in some deployments
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stage outputs.

    Read from ``spark.checkpoint.dir``; only when unset (local tests) a fresh
    scratch folder is created and registered.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if cur:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(cur)
        return cur
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
    d = tempfile.mkdtemp(prefix="tallyrisk-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_tallyrisk_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tallyrisk-code-")
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "tallyrisk"), "zip", root, "tallyrisk"))
    sc._tallyrisk_shipped = True
