"""The corpus pipeline against the operators' brute-force rules."""

import hashlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from tallyrisk.llm import quality
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_and_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, frames[-1], SF)
        assert out.columns == columns, name
        frames.append(out.cache())
    ids = [sorted(r.doc_id for r in f.collect()) for f in frames]
    report = quality.quality_report(docs).collect()
    assert ids[1] == sorted(r.doc_id for r in report if r.kept)
    assert set(ids[2]) <= set(ids[1])
    assert len(ids[2]) >= 0.99 * len(ids[1])
    kept = sorted((r.doc_id, r.text) for r in frames[2].collect())
    comp = brute_components([brute_fingerprint(t) for _, t in kept])
    assert ids[3] == sorted({c: d for (d, _), c in reversed(list(zip(kept, comp)))}.values())
    items = [tuple(_words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {w[i:i + 10] for w in items for i in range(max(len(w) - 9, 1))}
    clean = [r.doc_id for r in frames[3].collect()
             if not any(tuple(_words(r.text))[i:i + 10] in grams for i in range(len(_words(r.text))))]
    assert ids[4] == sorted(clean)
    result = {r.doc_id: r for r in P.run(spark, SF).collect()}
    assert sorted(result) == ids[4]
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    for r in frames[4].collect():
        t = tokenizer.encode(r.text, add_special_tokens=False).ids
        assert result[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, t)).encode()).hexdigest()


def _words(text):
    import re
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def test_edge_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0
    some = docs.limit(30)
    odd = some.union(some.limit(3)).union(spark.createDataFrame(
        [(None, None, None, None, None), (9_000, "", "en", "s", 0)], docs.schema)).withColumns(
        {"h": F.lit("x"), "count": F.lit(1), "kept": F.lit(True), "words": F.lit(2.5)})
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns and out.count() <= odd.count(), name
    assert P.STAGES[-1][1](spark, odd, SF).count() == odd.count()
