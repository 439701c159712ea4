"""Language-model scores against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyrisk.llm import lm_score as L

SCHEMA = "doc_id long, text string"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def brute(rows, k2, k3):
    held = lambda d: zlib.crc32(str(d if d is not None else "").encode()) % 7 == 2
    uni, pair, triple = Counter(), Counter(), Counter()
    for d, t in rows:
        if not held(d):
            w = tokens(t)
            uni.update(w)
            pair.update(zip([None] + w, w))
            triple.update(zip([None] + w, w, w[1:]))
    n, v = sum(uni.values()), len(uni)
    p1 = lambda w: (uni[w] + 1) / (n + v + 1)
    p2 = lambda b, w: (pair[b, w] + k2 * p1(w)) / (uni[b] + k2)
    p3 = lambda a, b, w: (triple[a, b, w] + k3 * p2(b, w)) / (pair[a, b] + k3)
    out = []
    for d, t in rows:
        w = tokens(t)
        score = math.log10(p2(None, w[0])) + sum(math.log10(p3(*x)) for x in zip([None] + w, w, w[1:]))
        out.append((d, held(d), len(w), sum(uni[x] > 0 for x in w), n, sum(math.log10(p1(x)) for x in w), score))
    return out


def test_scores(spark):
    rng = random.Random(1)
    words = ["Ab", "ab", "cd", "éf", "gh ", "x\u00a0y", "\u3000", "zz\n"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(200)]
    rows += [(None, "ab cd"), (300, None), (301, ""), (302, "unseen words only"), (5, rows[5][1]), (303, "ab " * 30000)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"block": F.lit("clash"), "score": F.lit(0)})
    got = L.score_documents(docs, backoff=(7.0, 2.0)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:5])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(brute(rows, 7.0, 2.0), key=key)):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)


def automaton(texts, k=(3.0, 2.0)):
    b = L.Block(texts, [False] * len(texts))
    n, v = int(b.word_train.sum()), len(b.word_keys)
    lm = L.BackoffAutomaton(b, *(getattr(b, f"{x}_train").astype(float) for x in L.KINDS), n, v, k)
    return b, lm, 1 / (n + v + 1)


def test_weights_out_of_every_state_sum_to_one():
    b, lm, unknown = automaton(["a b a c a b b", "b b a", "c a b a b", ""])
    one = 10 ** lm.arc[0]
    assert math.isclose(one.sum() + unknown, 1.0)

    def full(state, arcs, lower, lower_unknown):
        """All words' probabilities from a state: its own arcs, else its failure arc and the next state's."""
        fail = 10 ** lm.failure[state]
        return np.array([arcs.get(w, fail * lower[w]) for w in range(len(one))]), fail * lower_unknown
    words = []
    for h in range(len(one)):
        arcs = {w: 10 ** lm.arc[1][i] for i, (x, w) in enumerate(zip(b.pair_before, b.pair_word)) if x == h}
        words.append(full(h + 1, arcs, one, unknown))
        assert math.isclose(words[h][0].sum() + words[h][1], 1.0)
    for p in range(len(b.pair_keys)):
        if b.pair_word[p] != b.end:     # nothing follows the end of a text
            arcs = {b.pair_word[b.triple_tail[i]]: 10 ** lm.arc[2][i] for i, x in enumerate(b.triple_before) if x == p}
            low, low_unknown = words[b.pair_word[p]]
            every, rest = full(lm.first_pair + p, arcs, low, low_unknown)
            assert math.isclose(every.sum() + rest, 1.0)


def test_states_are_the_longest_seen_endings():
    texts = ["a b c", "b c a", "x a b"]
    b = L.Block(texts, [False, False, True])
    lm = L.BackoffAutomaton(b, *(getattr(b, f"{x}_train").astype(float) for x in L.KINDS),
                            int(b.word_train.sum()), 4, (3.0, 2.0))
    state = lm.states().tolist()
    assert state[0] == state[4] == state[8] == lm.start > 0
    assert all(x >= lm.first_pair for x in state[1:4] + state[5:8])
    assert state[9] == 0                              # x was never trained: the root
    assert 0 < state[10] < lm.first_pair              # x a was not, a was: the word's state
    assert state[11] == state[2]                      # a b: the pair's, the same as in the first text


def test_repeated_rows_spread_over_the_blocks(spark):
    docs = spark.range(0, 4000, 1, 4).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b a b").alias("text"))
    r = L.score_documents(docs).agg(F.count("*").alias("n"), F.countDistinct("score").alias("d"),
                                    F.first("n_tokens").alias("t")).first()
    assert (r.n, r.d, r.t) == (4000, 1, 5)
    src = docs.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(64)))
    assert src.groupBy("block").count().agg(F.max("count")).first()[0] < 200


def test_bytes_of_a_key_follow_the_tokens():
    assert [L.key_bytes(x) for x in (0, 1 << 28, 1 << 29, 1 << 36, 1 << 37, 1 << 50)] == [6, 6, 7, 7, 8, 8]
    wide, narrow = L.Block(["a b c a b"], [False], 8), L.Block(["a b c a b"], [False], 6)
    assert (wide.pair_keys >> np.uint64(16) << np.uint64(16)).tolist() == narrow.pair_keys.tolist()
    assert (narrow.triple_keys & np.uint64(0xFFFF)).tolist() == [0] * len(narrow.triple_keys)


def test_held_out_text_is_predicted_better_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = L.score_documents(docs).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def test_empty_and_untrained(spark):
    assert L.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = L.score_documents(spark.createDataFrame([(alone, "a b")], SCHEMA)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
    assert np.isfinite(r.score)


def test_counts_beyond_32_bits():
    n = np.array([2 ** 32 + 5, 0, 1, 2 ** 40], np.int64)
    assert L.unpack_counts(L.pack_counts(n)).tolist() == n.tolist()
    keys = L.pack_keys(np.array([7, 9], np.uint64))
    one = pa.array([keys, keys], pa.binary())
    count = pa.array([L.pack_counts(np.array([2 ** 31, 3]))] * 2, pa.binary())
    table = pa.table({"bucket": pa.chunked_array([pa.array([0, 0], pa.int32())]),
                      "block": pa.chunked_array([pa.array([1, 2], pa.int32())]),
                      **{f"{k}_keys": one for k in L.KINDS}, **{f"{k}_n": count for k in L.KINDS}})
    for k in L.KINDS:
        assert [L.unpack_counts(x).tolist() for x in L._count(table).column(f"{k}_n").to_pylist()] == [[2 ** 32, 6]] * 2
