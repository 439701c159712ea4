"""SimHash fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyrisk.llm import simhash as S

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


def near(rng, x, bits):
    for b in rng.sample(range(64), bits):
        x ^= 1 << b
    return x


@pytest.mark.parametrize("max_group", [64, 1024])
def test_links_equal_brute_force(spark, max_group):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for x in fps[:20]:
        fps += [near(rng, x, k) for k in (1, 2, 3, 4, 5)]
    dense = rng.getrandbits(64)
    fps += [near(rng, dense, rng.randint(0, 2)) for _ in range(120)]
    fps = sorted(set(fps))
    frame = spark.createDataFrame([(S._signed(x),) for x in fps], "fp long")
    links = S.link_fingerprints(frame, 3, max_group)
    assert links.filter("a = b").count() == 0
    roots = {r.node: r.root for r in S.components(links).collect()}
    mine = [roots.get(S._signed(x), S._signed(x)) for x in fps]
    want = brute_components(fps)
    pairs = {}
    for m, w in zip(mine, want):
        assert pairs.setdefault(w, m) == m
    assert len(set(pairs.values())) == len(pairs)
    for a, b in links.collect():
        assert ((a ^ b) & S.FULL).bit_count() <= 3


def test_gray_rank_orders_a_gray_code():
    code = np.arange(256, dtype=np.uint64)
    code ^= code >> np.uint64(1)
    assert (S.gray_rank(code) == np.arange(256)).all()


def test_documents(spark):
    rng = random.Random(8)
    text = [" ".join(rng.choice("alpha beta gamma delta rho tau phi chi psi eta".split()) for _ in range(200))
            for _ in range(6)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(text)]
    rows += [(20, text[0], "en", "s", 0), (21, text[0] + " x", "en", "s", 0), (22, "Two Words", "en", "s", 0),
             (23, "two\twords", "en", "s", 0), (30, None, None, None, None), (31, "", "en", "s", 0),
             (32, " \n", "en", "s", 0), (None, text[1], "en", "s", 0), (2, text[2], "en", "s", 0),
             (2, text[2], "fr", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"fp": F.lit("clash"), "component_id": F.lit(0.5)})
    got = S.simhash_components(docs).collect()
    assert len(got) == len(rows)
    fps = [brute_fingerprint(r[1]) for r in rows]
    comp = brute_components(fps)
    smallest = {}
    for r, c in zip(rows, comp):
        if r[0] is not None:
            smallest[c] = min(smallest.get(c, 1 << 60), r[0])
    want = sorted((r[0] is None, r[0] or 0, f"{f:016x}", smallest[c]) for r, f, c in zip(rows, fps, comp))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in got) == want
    kept = S.simhash_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(smallest.values()))


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert S.simhash_components(docs).count() == 0 and S.simhash_dedup(docs).count() == 0


def test_votes_in_slices(monkeypatch):
    from tallyrisk.llm import simhash as S
    text = " ".join(f"w{i % 97} v{i % 13}" for i in range(700))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "VOTES", 100)
    assert S.fingerprint(text) == whole == S.fingerprint(text.upper())
