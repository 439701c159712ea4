"""Proportional stratified interleaving."""

import zlib
from collections import Counter
from fractions import Fraction

from pyspark.sql import functions as F

from tallyrisk.llm import shard as S

SCHEMA = "doc_id long, text string, source string"


def rows_of(n):
    return [(i, f"text é {i % 7}", ["hot", "hot", "hot", "a", None, f"s{i % 5}"][i % 6]) for i in range(n)]


def test_law_and_mixture(spark):
    rows = rows_of(1000) + [(None, None, "a"), (None, "", None), (5, rows_of(6)[5][1], rows_of(6)[5][2])]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"pos": F.lit("clash"), "r": F.lit(1), "h": F.lit(2)})
    got = S.interleave(docs, range_rows=64).collect()
    n = len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert sorted(r.pos for r in got) == list(range(n))
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for k in range(16):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sizes[k]))
    for source, total in Counter(r.source for r in got).items():
        per = Counter(r.shard for r in got if r.source == source)
        for k in range(16):
            assert abs(per.get(k, 0) - total * sizes[k] / n) <= 2


def test_order_is_the_fractional_rank(spark):
    docs = spark.createDataFrame(rows_of(300), SCHEMA)
    hashed = docs.select("doc_id", "source", F.xxhash64(F.lit(42), "doc_id", F.crc32(F.encode("text", "UTF-8")),
                                                        (F.octet_length("text") + 1).cast("long")).alias("h")).collect()
    total, rank, place = Counter(r.source for r in hashed), Counter(), {}
    for r in sorted(hashed, key=lambda r: r.h):
        rank[r.source] += 1
        place[r.doc_id] = Fraction(2 * rank[r.source] - 1, 2 * total[r.source])
    got = sorted(S.interleave(docs, range_rows=64).collect(), key=lambda r: r.pos)
    order = [place[r.doc_id] for r in got]
    assert order == sorted(order)


def test_write(spark, tmp_path):
    docs = spark.createDataFrame(rows_of(100) + [rows_of(1)[0]], SCHEMA)
    S.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.groupBy("shard").count().count() == 4
    assert back.select("doc_id", "text", "source").exceptAll(docs).count() == 0 and back.count() == 101


def test_empty(spark):
    out = S.interleave(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and {"shard", "slot", "pos"} <= set(out.columns)
