"""Quality rules against brute force, and their edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    syllables = ["ba", "lo", "ti", "ren", "sha", "mu", "ké", "po", "vi", "son"]
    vocabulary = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(400)]
    rows = [(i, sentence(rng, rng.randint(60, 160), vocabulary) + ".\nEnd of it\nEnd of it", "en", "s", 0)
            for i in range(60)]
    rows += [(100, " ".join("".join(rng.choices("qxzjk@%0w", k=9)) for _ in range(120)), "en", "s", 0),
             (101, "one two three " * 60, "en", "s", 0), (102, None, "en", "s", 0), (103, "", None, "s", 0),
             (104, "few words here", "xx", "s", 0), (None, rows[0][1], "en", None, None), rows[0], rows[0]]
    return rows


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(inside))


def test_counts_and_verdicts(spark, corpus):
    docs = spark.createDataFrame(corpus, SCHEMA).withColumn("kept", F.lit("clash"))
    got = Q.quality_report(docs).collect()
    assert len(got) == len(corpus)
    by_text = {}
    for r in got:
        by_text.setdefault(r.doc_id, r)
    for doc_id, text, *_ in corpus:
        r = by_text[doc_id]
        want = counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert all(by_text[i].kept for i in range(60))
    assert not any(by_text[i].kept for i in (100, 101, 102, 103, 104))


def test_filter_keeps_columns_and_agrees(spark, corpus):
    docs = spark.createDataFrame(corpus, SCHEMA).withColumn("_q_", F.lit(1)).withColumn("n_words", F.lit("x"))
    kept = Q.quality_filter(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    want = sorted((r.doc_id is None, r.doc_id or 0) for r in Q.quality_report(docs).collect() if r.kept)
    assert ids == want and len(ids) == 63


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert Q.quality_report(docs).count() == 0
    assert Q.quality_filter(docs).count() == 0


def test_model_is_a_distribution_and_matches_brute_force():
    words = [b"abba", b"abab", b"bab", b"ca", b"abba", b"a"]
    distinct = sorted(set(words))
    grams, starts = Q.word_grams(distinct)
    weight = np.repeat([words.count(w) for w in distinct], np.diff(np.append(starts, len(grams))))
    lm = Q.KneserNey(grams, weight)
    context = int(grams[2]) >> 6
    p = lm.probability(np.array([context << 6 | c for c in range(64)]))
    assert math.isclose(p.sum(), 1.0, rel_tol=1e-9) and (p > 0).all()
    # counts by hand: letters padded with edges, every word weighted by its occurrences
    want = {}
    for w in words:
        s = [0, 0, 0, *(c - 96 for c in w), 0]
        for i in range(3, len(s)):
            key = s[i - 3] << 18 | s[i - 2] << 12 | s[i - 1] << 6 | s[i]
            want[key] = want.get(key, 0) + 1
    got = {}
    for g, n in zip(grams.tolist(), weight.tolist()):
        got[g] = got.get(g, 0) + n
    assert got == want
    # highest order by hand: (c - D(c)) / c(h) + backoff * lower
    key = max(want, key=want.get)
    c_h = sum(n for g, n in want.items() if g >> 6 == key >> 6)
    at = list(lm.context[4]).index(key >> 6)
    lower = lm.probability(np.array([key & 0x3FFFF]), 3)[0]
    discount = [0] + [min(max(i - (i + 1) * y, 0.05), i - 0.05) for i, y in _ratios(want)]
    n = want[key]
    assert math.isclose(lm.probability(np.array([key]))[0],
                        (n - discount[min(n, 3)]) / c_h + lm.backoff[4][at] * lower, rel_tol=1e-9)


def _ratios(table):
    n = [sum(v == k for v in table.values()) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    return [(i, y * n[i] / n[i - 1] if n[i - 1] else (i - 0.5) / (i + 1)) for i in (1, 2, 3)]


def test_long_text(spark):
    docs = spark.createDataFrame([(1, "word " * 400_000, "en", "s", 0)], SCHEMA)
    r = Q.quality_report(docs).first()
    assert r.n_words == 400_000 and r.n_repeat_words == 400_000 and r.base_failed and not r.kept


def test_characters_that_share_low_bits_with_the_separator(spark, corpus):
    grams, starts = Q.word_grams(["a\U0002000Ab".encode(), "\U0001000A".encode(), b"c"])
    assert starts.tolist() == [0, 4, 6] and len(grams) == 8
    rows = [*corpus, (200, corpus[0][1] + " \U0002000A\U0001000Ax", "en", "s", 0)]
    got = {r.doc_id: r for r in Q.quality_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[200].n_words == got[0].n_words + 1 and got[200].kept


def test_grams_run_across_words():
    """Borders and word insides together are the 4-grams of the running symbols, by hand."""
    texts = ["abc d efgh d", None, "x", "", "d abc"]
    words, ids, offsets = Q.index_words(texts)
    heads, tails = Q.word_borders(words)
    got = Counter()
    for g in Q.seam_grams(Q.seams(ids, offsets, heads, tails)):
        got.update(g.tolist())
    inner, size, _, _ = Q.word_parts(words)
    for g, w in zip(inner.tolist(), np.repeat(np.arange(len(words)), size)):
        got[g] += int((ids == w).sum())
    want = Counter()
    for t in texts:
        s = [0, 0, 0] + [ord(c) - 96 if c != " " else 0 for c in (t + " " if t else "")]
        want.update(s[i - 3] << 18 | s[i - 2] << 12 | s[i - 1] << 6 | s[i] for i in range(3, len(s)))
    assert got == want


def test_counted_grams_match_running_text(spark):
    texts = ["alpha beta a gamma", "beta alpha", "a a b"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r.gram: r.n for r in Q.count_grams(docs).collect()}
    want = Counter()
    for t in texts:
        s = [0, 0, 0] + [ord(c) - 96 if c != " " else 0 for c in t + " "]
        want.update((1 << 24) | s[i - 3] << 18 | s[i - 2] << 12 | s[i - 1] << 6 | s[i] for i in range(3, len(s)))
    assert got == want


def test_word_order_counts(spark):
    rng = random.Random(5)
    ends = ["ora", "uti", "ene"]     # a word that ends on a vowel is followed by one that starts with its fellow
    follow = {"a": "s", "i": "m", "e": "p"}

    def running(n):
        out, first = [], "s"
        for _ in range(n):
            out.append(first + rng.choice(ends))
            first = follow[out[-1][-1]]
        return out
    texts = [running(100) for _ in range(60)]
    mixed = list(texts[0])
    rng.shuffle(mixed)
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 0) for i, t in enumerate([*texts, mixed])], SCHEMA)
    got = {r.doc_id: r.log_ppl_letter for r in Q.quality_report(docs).collect()}
    assert got[60] > 1.2 * got[0]


def test_other_alphabets_have_classes():
    of = Q.symbol_classes()
    cyrillic = [ord(c) for c in "абвгдежзклмнопрстуфхцчшщъыьэюя"]
    assert len({int(of[c]) for c in cyrillic}) == len(cyrillic)
    assert [of[ord(c)] for c in "ПРИВЕТ"] == [of[ord(c)] for c in "привет"]
    assert len({int(of[c]) for c in range(0x3B1, 0x3CA)}) == 25 and of[ord("é")] == of[ord("e")]


def test_small_class_gets_the_pooled_bands(spark, corpus):
    rng = random.Random(9)
    junk = [(300 + i, " ".join("".join(rng.choices("qxzjk@%0w", k=9)) for _ in range(120)), "xx", "s", 0)
            for i in range(3)]
    docs = spark.createDataFrame([*corpus, *junk], SCHEMA)
    kept = {r.doc_id: r.kept for r in Q.quality_report(docs).collect()}
    assert not any(kept[300 + i] for i in range(3)) and all(kept[i] for i in range(60))


def test_every_character_is_its_own_symbol():
    every = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000])
    for characters, most in ((every[:300], 15), (every, 15), (every[:300], 6)):
        alphabet = Q.Alphabet(characters, most)
        assert alphabet.bits <= most and alphabet.size <= 1 << alphabet.bits
        known = np.setdiff1d(characters, [ord(c) for c in Q.SPACES])
        at = alphabet.symbols(np.insert(known, range(1, len(known) + 1), 10))     # a word edge behind each
        assert at.max() == alphabet.size - 1
        spelled = np.split(at, np.flatnonzero(at == 0) + 1)[:-1]
        assert len({x.tobytes() for x in spelled}) == len(known) and max(map(len, spelled)) <= 3


def test_characters_of_two_symbols_keep_the_words_apart():
    texts = ["abc d efgh d", None, "h", "", "d abc"]
    alphabet = Q.Alphabet(np.frombuffer("abcdefgh".encode("utf-32-le"), np.uint32), 3)    # 7 symbols for 8 letters
    words, ids, offsets = Q.index_words(texts)
    got = Counter()
    for g in Q.seam_grams(Q.seams(ids, offsets, *Q.word_borders(words, alphabet), alphabet.bits), alphabet.bits):
        got.update(g.tolist())
    inner, size, _, _ = Q.word_parts(words, alphabet)
    for g, w in zip(inner.tolist(), np.repeat(np.arange(len(words)), size)):
        got[g] += int((ids == w).sum())
    want = Counter()
    for t in texts:
        points = np.frombuffer((t.replace(" ", "\n") + "\n" if t else "").encode("utf-32-le"), np.uint32)
        s = [0, 0, 0, *alphabet.symbols(points).tolist()]
        want.update(s[i - 3] << 9 | s[i - 2] << 6 | s[i - 1] << 3 | s[i] for i in range(3, len(s)))
    assert got == want


def test_characters_of_one_class_are_told_apart(spark):
    """U+4E00 and U+4E20 were one class, as were a capital and its small letter, and e with and without a mark."""
    rng = random.Random(11)
    fellow = str.maketrans("一丁丂七et", "丠両丢丣ÉT")
    texts = [" ".join("".join(rng.choices(["一丁", "丂七", "et"], k=3)) for _ in range(100)) for _ in range(61)]
    texts[60] = "".join(c.translate(fellow) if rng.random() < 0.5 else c for c in texts[60])
    docs = spark.createDataFrame([(i, t, "xx", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in Q.quality_report(docs).collect()}
    assert got[60].log_ppl_letter > 1.2 * max(got[i].log_ppl_letter for i in range(60))
    assert not got[60].kept and all(got[i].kept for i in range(60))
