"""Decontamination against brute force."""

import re

import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import decontam as D

DOCS = "doc_id long, text string, lang string"
W = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()
BENCH = [(1, " ".join(W[:12])), (2, " ".join(W[2:12])), (3, "Short, item!"), (3, "Short, item!"), (None, "ünï Éa 42"),
         (4, None), (5, ""), (6, "...")]
ROWS = [(1, "x " + " ".join(W[:12]) + " y", "en"), (2, " ".join(W[1:11]).upper(), "en"), (3, " ".join(W[:9]), "en"),
        (4, "a short ITEM b short... item", "en"), (5, "ünï Éa 42, ünï éa 42", "en"), (6, None, None), (7, "", "en"),
        (None, " ".join(W[2:12]), "en"), (8, "clean text", "en"), (1, "x " + " ".join(W[:12]) + " y", "en")]


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, size=10):
    w, covered, items = words(text), set(), set()
    for item, t in BENCH:
        g = words(t)
        n = min(size, len(g))
        for i in range(len(g) - n + 1 if g else 0):
            for k in range(len(w) - n + 1):
                if w[k:k + n] == g[i:i + n]:
                    covered |= set(range(k, k + n))
                    items.add("" if item is None else str(item))
    return len(w), sorted(covered), sorted(items)


@pytest.mark.parametrize("limit", [64 << 20, 200])
def test_contamination(spark, limit):
    docs = spark.createDataFrame(ROWS, DOCS).withColumn("words", F.lit(3)).withColumn("h", F.lit("clash"))
    bench = spark.createDataFrame(BENCH, "item_id long, text string").withColumn("len", F.lit(0))
    got = D.contamination(docs, bench, broadcast_bytes=limit).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = []
    for doc_id, text, _ in ROWS:
        n, hit, items = brute(text)
        want.append((doc_id, n, len(hit), len(items), items, bool(hit)))
    have = [(r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)


def test_filters(spark):
    docs = spark.createDataFrame(ROWS, DOCS).withColumn("n_words", F.lit("clash"))
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 7, 8]
    spans = D.decontaminate(docs, bench, mode="span")
    assert spans.columns == docs.columns and spans.count() == len(ROWS)
    by = {r.doc_id: r.text for r in spans.collect()}
    assert by[1] == "x  y" and by[8] == "clean text" and by[6] is None and by[3] == ROWS[2][1]
    assert by[4] == "a  b " and words(by[5]) == ["ünï", "éa", "42"]


def test_empty(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(docs, none).filter("contaminated").count() == 0
    assert D.contamination(docs, none).count() == len(ROWS)
    assert D.contamination(spark.createDataFrame([], DOCS), spark.createDataFrame(BENCH, "item_id long, text string")
                           ).count() == 0


def test_a_long_text_costs_in_proportion(spark):
    """A text of a million words, with benchmark passages at both ends and in the middle."""
    import time
    passage = " ".join(W[:12])
    filler = "lorem ipsum dolor sit amet consectetur"
    middle = " ".join([filler] * 83_000)
    text = f"{passage} {middle} {passage} {middle} {passage}"
    docs = spark.createDataFrame([(1, text, "en"), (2, "clean", "en")], DOCS)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    began = time.time()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in D.contamination(docs, bench).collect()}
    assert got == {1: (2 * 83_000 * 6 + 36, 36, 2), 2: (1, 0, 0)}
    assert time.time() - began < 60
