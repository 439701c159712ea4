"""Shuffle partitions follow the tables' stored bytes, so that no task's share grows with them."""

import os

from tallyrisk import session as S

KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def _stored(folder, size):
    folder.mkdir()
    with open(os.path.join(folder, "t.parquet"), "wb") as f:
        f.truncate(size)
    return str(folder)


def test_initial_partitions_grow_with_the_tables(spark, tmp_path):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    large = 10 * least * S.TABLE_BYTES_PER_PARTITION
    try:
        S.size_shuffles(spark, _stored(tmp_path / "small", 10))
        assert int(spark.conf.get(KEY)) == least
        S.size_shuffles(spark, _stored(tmp_path / "large", large))
        assert int(spark.conf.get(KEY)) == 10 * least
        spark.conf.set(KEY, "7")                  # a caller's own setting stays
        S.size_shuffles(spark, str(tmp_path / "small"))
        assert spark.conf.get(KEY) == "7"
    finally:
        spark.conf.unset(KEY)


def test_partition_bytes_are_set_only_over_sparks_default(spark):
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.unset(k)
        S.apply_runtime_defaults(spark)
        assert [spark.conf.get(k) for k in keys] == ["8m", "32m"]
        spark.conf.set(keys[0], "5m")
        S.apply_runtime_defaults(spark)
        assert spark.conf.get(keys[0]) == "5m"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
