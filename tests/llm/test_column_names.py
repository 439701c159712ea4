"""Columns of a caller may have any name: every filter keeps them as they are."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import tallyrisk.llm as package
from tallyrisk.llm import decontam, host_rep, langid, quality, shard, simhash

SF = "/root/testdata/sf0.001"
FOLDER = Path(list(package.__path__)[0])
#: Every name that the operators' sources give to a column, and some that only differ in case or need quotes.
NAMES = sorted({n for f in ("decontam", "langid", "simhash", "quality", "host_rep", "shard", "common")
                for n in re.findall(r'"([_A-Za-z]\w{0,18})"', (FOLDER / f"{f}.py").read_text())}
               - {"doc_id", "text", "lang", "source", "n_chars", "page_id", "url", "html", "shard", "slot"})
NAMES = [n for i, n in enumerate(NAMES) if n.lower() not in {m.lower() for m in NAMES[:i]}]
ODD = ["TEXT", "Doc_Id", "LANG", "Source", "a.b", "other column 1", "_h10", "_p4", "_s10_8", "_q_"]


def with_columns(df, names):
    names = [n for n in names if n not in df.columns]
    values = [F.lit(f"own {n}").alias(n) for n in names]
    return df.select(*df.columns, *values), names


FILTERS = {
    "quality": lambda spark, d: quality.quality_filter(d),
    "language": lambda spark, d: langid.language_filter(d),
    "simhash": lambda spark, d: simhash.simhash_dedup(d),
    "decontaminate": lambda spark, d: decontam.decontaminate(d, spark.read.parquet(f"{SF}/benchmark.parquet")),
    "spans": lambda spark, d: decontam.decontaminate(d, spark.read.parquet(f"{SF}/benchmark.parquet"), "span"),
}


@pytest.mark.parametrize("name", sorted(FILTERS))
def test_filters_keep_columns_of_any_name(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    odd = [] if name == "quality" else ODD      # names that differ in case only are the caller's to resolve there
    wide, names = with_columns(docs, NAMES + odd)
    assert len(names) > 60
    want = {r.doc_id for r in FILTERS[name](spark, docs).collect()}
    got = FILTERS[name](spark, wide)
    assert got.columns == wide.columns
    rows = got.toDF(*[f"c{i}" for i in range(len(wide.columns))]).collect()
    assert {r[0] for r in rows} == want
    for r in rows:
        assert list(r)[len(docs.columns):] == [f"own {n}" for n in names]


def test_url_filter_and_shards(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet").limit(60)
    outcomes = spark.createDataFrame([], "page_id long, bad int")
    wide, names = with_columns(pages, NAMES + ["PAGE_ID", "URL"])
    got = host_rep.filter_urls(wide, outcomes)
    assert got.columns == wide.columns and got.count() == host_rep.filter_urls(pages, outcomes).count()
    docs, _ = with_columns(spark.read.parquet(f"{SF}/documents.parquet").limit(40), [n for n in NAMES if n != "pos"])
    shard.write_shards(docs, str(tmp_path / "out"), shards=3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40
    with pytest.raises(ValueError, match="shard"):
        shard.write_shards(docs.withColumn("SHARD", F.lit(1)), str(tmp_path / "no"))
