"""Weighted fair queueing against a sequential queue."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import mix as M

SCHEMA = "doc_id long, text string, source string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, epochs=3, weights=(5, 2, 1)):
    """The stated rule, step by step: whatever is above its cap stops there, the rest is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    budget = Fraction(sum(sizes.values()))
    while open_:
        left = budget - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > epochs * sizes[s]}
        if not above:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: Fraction(epochs * sizes[s]) for s in above}
        open_ -= above
    return target


def brute_mix(rows, seed=42):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    target = brute_targets(sizes)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    seen, docs = Counter(), defaultdict(list)
    for d, t, s in rows:
        n = words(t)
        copy = seen[d, s, n]
        seen[d, s, n] += 1
        key = f"{seed}|{'' if d is None else d}|{n}|{copy}"
        docs[s].append((int(hashlib.md5(key.encode()).hexdigest()[:15], 16), d is not None, d or 0, n, copy))
    offers = []
    for s, own in docs.items():
        sent = 0
        for epoch in range(1, 4):
            for doc in sorted(own):
                sent += doc[3]
                if target[s] > 0:
                    offers.append((float(sent) / float(target[s]), names.index(s), doc, epoch))
    taken, total = Counter(), 0
    for _, place, doc, _ in sorted(offers):
        total += doc[3]
        if total > sum(sizes.values()):
            break
        taken[names[place], doc] += doc[3]
    return target, sorted((d[2] if d[1] else -1, d[3], sizes[s], taken[s, d]) for s, own in docs.items() for d in own)


ROWS = ([(i, " ".join(["w"] * (i * 7 % 13)), "hot") for i in range(300)]
        + [(1000 + i, "a b\tc\x0bd" * (i % 5), "é") for i in range(20)] + [(2000, "one", None), (None, "x y", "Z")]
        + [(3000, "same words here", "b")] * 12 + [(4000, None, "b"), (4001, "", "none"), (None, None, "Z")])


@pytest.mark.parametrize("chunk", [4096, 5])
def test_against_the_sequential_queue(spark, monkeypatch, chunk):
    monkeypatch.setattr(M, "CHUNK", chunk)
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({"size": F.lit("clash"), "h": F.lit(1), "place": F.lit(2)})
    got = M.mix_report(docs.repartition(7)).collect()
    target, want = brute_mix(ROWS)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r["size"], r.source_size, r.taken) for r in got) == want
    for r in got:
        assert r.target == pytest.approx(float(target[r.source]), rel=1e-12) and r.taken <= 3 * r["size"]
    # One document at most lies between a source and its target.
    for s, t in target.items():
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - float(t)) <= 2 * max(r["size"] for r in own)


def test_caps_and_weights():
    assert brute_targets({"a": 10, "b": 1000, "c": 10}) == {"a": 30, "c": 30, "b": 960}


def test_one_hot_row(spark):
    """A row that is a third of all spreads and is counted row by row."""
    rows = [(7, "a b c", "x")] * 400 + [(i, "d e", "y") for i in range(800)]
    got = M.mix_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 1200 and sum(r.doc_id == 7 and r.source == "x" for r in got) == 400
    assert [(-1 if r.doc_id is None else r.doc_id, r["size"], r.source_size, r.taken) for r in
            sorted(got, key=lambda r: (r.doc_id, r["size"], r.source_size, r.taken))] == brute_mix(rows)[1]


def test_written_mix(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("finish", F.lit(0))
    M.write_mix(docs, str(tmp_path / "mix"))
    back = spark.read.parquet(str(tmp_path / "mix"))
    assert back.columns == docs.columns
    report = M.mix_report(docs)
    assert sum(words(r.text) for r in back.collect()) == report.agg(F.sum("taken")).first()[0]


def test_empty(spark):
    assert M.mix_report(spark.createDataFrame([], SCHEMA)).count() == 0
    none = M.mix_report(spark.createDataFrame([(1, None, None), (2, " ", "a")], SCHEMA)).collect()
    assert [(r["size"], r.target, r.taken) for r in none] == [(0, 0.0, 0)] * 2
