"""The divergence audit against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string"
S = 1_000_000_000


def terms(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, top=200):
    by, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source, t = lang or "", source or "", terms(text)
        groups[lang].add(source)
        by[lang, source].update(t)
        df[lang].update(set(t))
    out = []
    for lang, sources in groups.items():
        kept = {t for t, n in df[lang].items() if n >= 3}
        v = len(kept)

        def shares(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + S * (counts[t] + 1) // (n + v) for t in kept}
        whole = sum((by[lang, s] for s in sources), Counter())
        p = {s: shares(by[lang, s]) for s in sources}
        q = shares(whole)
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s]
            own = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if by[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(own)[:top])):
                out += [(lang, s, part, item.decode(), -f, i + 1) for i, (f, item) in enumerate(sorted(found))]
    return sorted(out)


def corpus(n=120):
    rng = random.Random(5)
    vocab = ["The", "the", "Ünï", "ünï", "a1b", "x-y", "straße", "Ж", "日本", "tail"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 30))), rng.choice(["en", "de"]),
             rng.choice(["hot", "hot", "hot", "s1", "s2", "é"])) for i in range(n)]
    return rows + [(None, None, None, None), (1, "the the the", "en", None), (2, "", "xx", "lonely"), (3, "!!", "xx", "other"),
                   (rows[0][0], *rows[0][1:])] + [(9, "solo", "one", "s")] * 3


def found(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


def test_against_brute_force(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"term": F.lit("clash"), "n": F.lit(1), "rank": F.lit(2)})
    want = brute(rows)
    assert {r[2] for r in want} == {"pair", "term"}
    assert found(D.source_divergence(docs)) == want
    # Small dictionaries, small blocks and other partitions change nothing; the limit of ranks holds.
    monkeypatch.setattr(D, "PENDING_BYTES", 200)
    monkeypatch.setattr(D, "chunks", lambda texts: ((i, i + 1) for i in range(len(texts))))
    audit = D.Audit(docs.repartition(5))
    assert found(audit.pair_rows(block_counts=10).unionByName(audit.term_rows(top=3))) == brute(rows, top=3)


def test_pair_sums_are_exact():
    rng = np.random.default_rng(1)
    k, n = 5, 40
    p = np.full((k, n), 0, np.int64)
    absent = rng.integers(1, 1000, k)
    p[:] = absent[:, None]
    mask = rng.random((k, n)) < 0.4
    mask[3] = False
    p[mask] = rng.integers(1, S + 1, int(mask.sum()))
    source, term = np.nonzero(mask)
    want = [[sum((int(a) - int(b)) ** 2 // int(b) for a, b in zip(p[g], p[h])) for h in range(k)] for g in range(k)]
    assert D.pair_sums(source, term, p[mask], absent, n).tolist() == want


@pytest.mark.parametrize("n", [0, 5, 8_999_999_999, 9_000_000_000, 10**12])
def test_shares_are_exact(spark, n):
    df = spark.createDataFrame([(n, 3 * n + 7)], "n long, t long")
    assert df.select(D._scaled("n", "t")).first()[0] == 1 + S * (n + 1) // (3 * n + 7)


def test_long_text_and_empty(spark):
    long = [(1, "alpha " * 300_000, "en", "a"), (2, "alpha beta", "en", "b"), (3, "alpha", "en", "a")]
    assert found(D.source_divergence(spark.createDataFrame(long, SCHEMA))) == brute(long)
    assert D.source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0
