"""Language identification: held-out accuracy, evidence fusion, edge cases."""

from pyspark.sql import functions as F

from tallyrisk.llm import langid as L

DOCS = "/root/testdata/sf0.01/documents.parquet"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DOCS)
    train, test = docs.filter("doc_id % 5 > 0"), docs.filter("doc_id % 5 = 0")
    pages = test.select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"),
                        F.col("text").alias("html"))
    got = L.identify_pages(pages, train).join(test.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("y")),
                                              "page_id")
    right = got.filter("lang = y").count()
    assert right / test.count() > 0.98


def test_priors_decide_short_texts(spark):
    docs = spark.read.parquet(DOCS)
    fr = docs.filter("lang = 'fr'").limit(30).collect()
    pages = [(i, f"http://a.site.fr/{i}", f'<html lang="fr"><p>{r.text}</p></html>') for i, r in enumerate(fr)]
    pages += [(100, "http://a.site.fr/x", '<html lang="fr"><p>de</p></html>'), (101, None, None),
              (102, "no host", "<p>12 34</p>"), (103, "http://a.site.fr/y", ""), (104, "http://a.site.fr/x", None)]
    out = {r.page_id: r for r in L.identify_pages(spark.createDataFrame(pages + pages[:1], PAGES), docs).collect()}
    assert out[100].lang == "fr" and out[100].declared == "fr"
    assert out[101].lang is None and out[102].lang is None and out[103].lang is None and out[104].lang is None
    assert L.identify_pages(spark.createDataFrame(pages + pages[:1], PAGES), docs).count() == len(pages) + 1
    assert abs(sum(out[100].posteriors) - 1) < 1e-9


def test_filter(spark):
    docs = spark.read.parquet(DOCS).limit(120)
    odd = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "12 34 !!", "en", "s", 0), (None, "", None, None, None)],
                                SCHEMA)
    both = docs.union(odd).withColumn("_extra", F.lit(1)).withColumn("host", F.lit("clash"))
    kept = L.language_filter(both)
    assert kept.columns == both.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or ""))


def test_empty(spark):
    assert L.language_filter(spark.createDataFrame([], SCHEMA)).count() == 0
    assert L.identify_pages(spark.createDataFrame([], PAGES), spark.createDataFrame([], SCHEMA)).count() == 0
