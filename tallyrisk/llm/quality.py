"""Quality rules: perplexity bands from a modified Kneser-Ney character model (operator 4).

The model is a 4-gram model over the characters of running text, one per language, counted by Spark
over every text; n-grams run across word edges, so the order of words counts. Grams inside a word
are counted per distinct word, the two that reach back over its leading edge per pair of word
borders. Every character of the corpus is a symbol of its own (capitals, marks, digits and the
characters of every script are told apart): one pass collects the distinct characters, at most
1.1 million, and a symbol is as wide as their number asks for, so that an n-gram and the language
pack into one 64-bit integer (a perfect hash). Where the characters are more than such a width
holds, those of the highest code points are written as two symbols. The
probabilities are stored in sorted arrays of those hashes. Each document's log-perplexity, per
word and per letter, is compared with an upper and a lower band of its language; the bands are
the quartiles over all documents widened by ``FENCES`` interquartile ranges. Marks glued to words
raise the first measure, marks standing alone lower the first and raise the second.

Defined results: a null or wordless text has zero counts, ``base_failed`` and is not kept; a null
or unlisted language is the class "other"; a language class whose documents show no spread
(fewer than ``min_docs``) has the bands of all classes together, and none where all documents
together are fewer; repeated rows are judged alike, one result per row; an
empty table gives an empty result; columns named like an output are replaced in it.
"""

from __future__ import annotations

import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrisk.llm.common import (append_columns, chunks, index_words, lookup, map_arrow,
                                  materialize, merge_counts, project_columns, sum_by_text)

LANGUAGES = ("de", "en", "es", "fr")
ORDER = 4
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
FENCES = {"word": 4.0, "letter": 5.0}       # interquartile ranges beyond the quartiles
LEAST_RANGE = {"word": 0.1, "letter": 0.02}  # an interquartile range counts as this at least
WORDS_AT_ONCE = 50_000  # distinct words whose n-grams are spelled out together
MAX_PENDING = 200_000   # distinct words a counting task holds before turning them into n-grams
MAX_POINT = 0x10FFFF    # the highest code point
MAX_SEAMS = 1_000_000   # border pairs a counting task holds before turning them into n-grams


class Classes:
    """Characters folded to the 64 symbols of ``symbol_classes``: for callers that want a model of fixed size."""
    bits, size = 6, 64

    def symbols(self, points: np.ndarray) -> np.ndarray:
        return classes_of(points)


class Alphabet:
    """A symbol for every one of the given characters; 0 is the word edge.

    Symbols are at most ``most_bits`` wide. Beyond that number of characters the highest code points
    take two symbols, a leading one of their own kind and a second one: no two characters are alike."""

    def __init__(self, characters: np.ndarray, most_bits: int = 15):
        self.characters = np.setdiff1d(np.asarray(characters, np.int64), [ord(c) for c in SPACES])
        n, room = len(self.characters), (1 << most_bits) - 1
        self.single, leads = n, 0
        if n > room:    # the least number of leading symbols that the rest needs
            leads = next(k for k in range(1, room) if (room - k) * (k + 1) >= n)
            self.single = room - leads
        self.size = self.single + leads + 1
        self.bits = max(1, (self.size - 1).bit_length())

    @cached_property
    def _table(self) -> np.ndarray:
        table = np.zeros(MAX_POINT + 1, np.int64)
        table[self.characters] = np.arange(1, len(self.characters) + 1)
        return table

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    def symbols(self, points: np.ndarray) -> np.ndarray:
        number = self._table[points]
        far = np.flatnonzero(number > self.single)
        if not len(far):
            return number
        rest = number[far] - self.single - 1
        number[far] = self.single + 1 + rest // self.single
        return np.insert(number, far + 1, 1 + rest % self.single)


@lru_cache(1)
def symbol_classes() -> np.ndarray:
    """Code point below 65536 -> class: 0 word edge, 1-26 letters without marks, 27 digits,
    28-59 ASCII punctuation and, by code point, the letters and marks of other alphabets (a run of
    32 letters gets 32 classes, small and capital Cyrillic or Greek the same), 60-63 the rest."""
    table = 60 + (np.arange(1 << 16) % 4).astype(np.int64)
    for cp in range(1 << 16):
        if 0xD800 <= cp < 0xE000:
            continue
        base = unicodedata.normalize("NFD", chr(cp))[0].lower()
        if len(base) == 1 and "a" <= base <= "z":
            table[cp] = 1 + ord(base) - ord("a")
        elif "0" <= base <= "9":
            table[cp] = 27
        elif cp > 127 and not 0x300 <= cp < 0x370 and unicodedata.category(base)[0] in "LM":
            table[cp] = 28 + ord(base) % 32
    punctuation = [c for c in range(33, 127) if not chr(c).isalnum()]
    for i, c in enumerate(punctuation):
        table[c] = 28 + i
    table[ord("\n")] = 0
    return table


def classes_of(points: np.ndarray) -> np.ndarray:
    """Classes of code points; those above 65535 are of the rest."""
    points = points.astype(np.int64)
    return np.where(points < 1 << 16, symbol_classes()[points & 0xFFFF], 60 + points % 4)


def _mask(symbols: int, bits: int) -> int:
    return (1 << (symbols * bits)) - 1


def word_grams(words: list[bytes], alphabet=Classes()) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of every word, the closing edge included, and where each word starts."""
    text = b"\n".join(words).decode() + "\n"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    a, w = alphabet.symbols(points), alphabet.bits

    def back(k):
        return np.concatenate([np.zeros(k, np.int64), a[:-k]])[:len(a)]
    p1 = back(1)
    p2 = np.where(p1 == 0, 0, back(2))
    p3 = np.where(p2 == 0, 0, back(3))
    ends = np.flatnonzero(a == 0)
    starts = np.concatenate([[0], ends[:-1] + 1])
    return (p3 << (3 * w)) | (p2 << (2 * w)) | (p1 << w) | a, starts


def word_parts(words: list[bytes], alphabet=Classes()) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed 4-grams that lie inside the words from their leading edge on, how many each word has,
    and the first two and last two symbols of each word (an edge where a word has only one)."""
    grams, starts = word_grams(words, alphabet)
    ends = np.append(starts[1:], len(grams)) - 1
    inner = np.ones(len(grams), bool)
    inner[starts] = inner[starts + 1] = False
    two = _mask(2, alphabet.bits)
    return grams[inner], ends - starts - 1, grams[starts + 1] & two, (grams[ends] >> alphabet.bits) & two


def word_borders(words: list[bytes], alphabet=Classes()) -> tuple[np.ndarray, np.ndarray]:
    """First two and last two symbols of each word."""
    parts = [word_parts(words[lo:lo + WORDS_AT_ONCE], alphabet)[2:] for lo in range(0, len(words), WORDS_AT_ONCE)]
    return np.concatenate([h for h, _ in parts]), np.concatenate([t for _, t in parts])


def seams(ids: np.ndarray, offsets: np.ndarray, heads: np.ndarray, tails: np.ndarray,
          bits: int = Classes.bits) -> np.ndarray:
    """Per token, the last two symbols before its leading edge and its first two; a text starts
    after edges."""
    before = np.zeros(len(ids), np.int64)
    before[1:] = tails[ids[:-1]]
    first = offsets[:-1]
    before[first[first < len(ids)]] = 0
    return (before << (2 * bits)) | heads[ids]


def seam_grams(seam: np.ndarray, bits: int = Classes.bits) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of a token's first and second symbol, which reach back over its leading edge."""
    before, head = seam >> (2 * bits), seam & _mask(2, bits)
    return (before << (2 * bits)) | (head >> bits), ((before & _mask(1, bits)) << (3 * bits)) | head


def _language_index(languages: tuple[str, ...]):
    index = {x: i for i, x in enumerate(languages)}
    return lambda lang: index.get(lang, len(languages))


def alphabet_of(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES, text: str = "text") -> Alphabet:
    """The characters of all texts; a gram of four symbols leaves room for the language class."""
    def run(batches):
        seen = np.zeros(MAX_POINT + 1, bool)
        for b in batches:
            texts = b.column(0).to_pylist()
            for lo, hi in chunks(texts):
                seen[np.frombuffer("".join(filter(None, texts[lo:hi])).encode("utf-32-le"), np.uint32)] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen).astype(np.int32))], names=["point"])
    points = map_arrow(docs.select(F.col(text)), run, "point int").distinct().toArrow()
    return Alphabet(points.column("point").to_numpy(), (63 - len(languages).bit_length()) // ORDER)


def count_grams(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES,
                text: str = "text", lang: str = "lang", alphabet=Classes()) -> DataFrame:
    """(gram, n) over all words of all texts; the language class sits above the bits of the gram."""
    bits, above = alphabet.bits, ORDER * alphabet.bits

    def run(batches):
        where = _language_index(languages)
        pending: dict[int, dict[bytes, int]] = {}
        borders: list[tuple[np.ndarray, np.ndarray]] = []
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def flush():
            nonlocal keys, counts
            for li, words in pending.items():
                spelled, times = list(words), np.fromiter(words.values(), np.int64, len(words))
                for lo in range(0, len(spelled), WORDS_AT_ONCE):
                    grams, size, _, _ = word_parts(spelled[lo:lo + WORDS_AT_ONCE], alphabet)
                    weight = np.repeat(times[lo:lo + WORDS_AT_ONCE], size)
                    k, c = merge_counts(grams | (li << above), weight)
                    keys, counts = merge_counts(np.concatenate([keys, k]), np.concatenate([counts, c]))
            pending.clear()
            if borders:
                s, n = merge_counts(*(np.concatenate(x) for x in zip(*borders)))
                both = [g | ((s >> above) << above) for g in seam_grams(s & _mask(ORDER, bits), bits)]
                keys, counts = merge_counts(np.concatenate([keys, *both]), np.concatenate([counts, n, n]))
                borders.clear()
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in chunks(texts):
                for li in {where(x) for x in langs[lo:hi]}:
                    words, ids, offsets = index_words([t if where(x) == li else None
                                                       for t, x in zip(texts[lo:hi], langs[lo:hi])])
                    if not words:
                        continue
                    s, n = np.unique(seams(ids, offsets, *word_borders(words, alphabet), bits), return_counts=True)
                    borders.append((s | (li << above), n))
                    here = pending.setdefault(li, {})
                    for w, n in zip(words, np.bincount(ids, minlength=len(words)).tolist()):
                        here[w] = here.get(w, 0) + n
                if sum(map(len, pending.values())) > MAX_PENDING or sum(len(s) for s, _ in borders) > MAX_SEAMS:
                    flush()
        flush()
        for i in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + 100_000]), pa.array(counts[i:i + 100_000])],
                                             names=["gram", "n"])
    rows = map_arrow(docs.select(F.col(text), F.col(lang)), run, "gram long, n long")
    return rows.groupBy("gram").agg(F.sum("n").alias("n"))


class KneserNey:
    """Interpolated modified Kneser-Ney probabilities in sorted arrays of packed n-grams."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet=Classes()):
        self.alphabet, bits = alphabet, alphabet.bits
        grams, counts = merge_counts(np.asarray(grams, np.int64), np.asarray(counts, np.int64))
        tables = {ORDER: (grams, counts)}
        for k in range(ORDER - 1, 0, -1):   # lower orders count distinct left neighbours
            above = tables[k + 1][0]
            suffix = ((above >> (bits * (k + 1))) << (bits * k)) | (above & _mask(k, bits))
            tables[k] = merge_counts(suffix, np.ones(len(suffix), np.int64))
        self.keys, self.prob, self.context, self.backoff = {}, {}, {}, {}
        for k in range(1, ORDER + 1):
            keys, c = tables[k]
            n = [int((c == i).sum()) for i in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
            d = np.array([0.0] + [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) if n[i - 1] else
                                  0.5 for i in (1, 2, 3)])
            discount = d[np.minimum(c, 3)]
            context, at = np.unique(keys >> bits, return_inverse=True)
            total = np.bincount(at, c, len(context))
            self.context[k] = context
            self.backoff[k] = np.bincount(at, discount, len(context)) / np.maximum(total, 1)
            lower = self._lower(keys, k)
            self.keys[k] = keys
            self.prob[k] = (c - discount) / total[at] + self.backoff[k][at] * lower

    def _shorten(self, keys: np.ndarray, k: int) -> np.ndarray:
        bits = self.alphabet.bits
        return ((keys >> (bits * k)) << (bits * (k - 1))) | (keys & _mask(k - 1, bits))

    def _lower(self, keys: np.ndarray, k: int) -> np.ndarray:
        return np.full(len(keys), 1 / self.alphabet.size) if k == 1 else self.probability(self._shorten(keys, k), k - 1)

    def probability(self, keys: np.ndarray, k: int = ORDER) -> np.ndarray:
        at, found = lookup(keys, self.keys[k])
        out = self.prob[k][at] if len(self.keys[k]) else np.zeros(len(keys))
        miss = np.flatnonzero(~found)
        if len(miss):
            ctx, known = lookup(keys[miss] >> self.alphabet.bits, self.context[k])
            gamma = np.where(known, self.backoff[k][ctx] if len(self.context[k]) else 1.0, 1.0)
            out = out.copy()
            out[miss] = gamma * self._lower(keys[miss], k)
        return out


def fit_model(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> KneserNey:
    """Count with Spark, then build the arrays from the distinct 4-grams of each language."""
    alphabet = alphabet_of(docs, languages)
    table = count_grams(docs, languages, alphabet=alphabet).toArrow()
    return KneserNey(table.column("gram").to_numpy(), table.column("n").to_numpy(), alphabet)


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.encode().split(b"\n"):
        if line.split(None, 1):
            n += line in seen
            seen.add(line)
    return n


def repeated_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that occur at least twice."""
    if len(ids) < 4:
        return 0
    _, local = np.unique(ids, return_inverse=True)
    base = np.int64(len(local) + 1)
    if base < 2_000_000:
        x = local.astype(np.int64)
        window = (x[:-2] * base + x[1:-1]) * base + x[2:]
    else:
        pair = np.unique(local[:-1] * base + local[1:], return_inverse=True)[1].astype(np.int64)
        window = pair[:-1] * base + local[2:]
    _, at, n = np.unique(window, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(n[at] > 1)
    marked = np.zeros(len(ids), bool)
    for k in range(3):
        marked[hit + k] = True
    return int(marked.sum())


_STATS = [T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
          T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
          T.StructField("n_repeat_words", T.LongType()), T.StructField("neg_log_prob", T.DoubleType()),
          T.StructField("n_letters", T.LongType())]


def _measurer(model, languages: tuple[str, ...]):
    """model: a broadcast of the KneserNey arrays."""
    def make():
        lm, where = model.value, _language_index(languages)
        alphabet, bits, above = lm.alphabet, lm.alphabet.bits, ORDER * lm.alphabet.bits

        def fn(texts, langs):
            words, ids, offsets = index_words(texts)
            n = np.diff(offsets)
            cost = np.zeros(len(texts))
            letters = np.zeros(len(texts))
            if words:
                length = np.fromiter((len(w.decode()) + 1 for w in words), np.int64, len(words))
                li = np.repeat([where(x) for x in langs], n)
                seam = seams(ids, offsets, *word_borders(words, alphabet), bits)
                each = np.zeros(len(ids))
                for one in set(li.tolist()):
                    mine = np.flatnonzero(li == one)
                    value = np.zeros(len(words))
                    at = np.unique(ids[mine])
                    for lo in range(0, len(at), WORDS_AT_ONCE):
                        part = at[lo:lo + WORDS_AT_ONCE]
                        grams, size, _, _ = word_parts([words[k] for k in part], alphabet)
                        inner = -np.log(lm.probability(grams | (one << above)))
                        value[part] = np.bincount(np.repeat(np.arange(len(part)), size), inner, len(part))
                    distinct, place = np.unique(seam[mine], return_inverse=True)
                    start = sum(-np.log(lm.probability(g | (one << above))) for g in seam_grams(distinct, bits))
                    each[mine] = value[ids[mine]] + start[place]
                some = np.flatnonzero(n)
                cost[some] = np.add.reduceat(each, offsets[some])
                letters = sum_by_text(length[ids].astype(float), offsets)
            chars, symbols, lines, repeats = [], [], [], []
            for i, t in enumerate(texts):
                t = t or ""
                chars.append(len(t) - sum(map(t.count, SPACES)))
                symbols.append(sum(map(t.count, SYMBOLS)))
                lines.append(duplicate_lines(t) if "\n" in t else 0)
                repeats.append(repeated_words(ids[offsets[i]:offsets[i + 1]]))
            return [n.tolist(), chars, symbols, lines, repeats, cost.tolist(), letters.astype(np.int64).tolist()]
        return fn
    return make


def _base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _log_ppl(unit: str):
    n = F.col("n_words" if unit == "word" else "n_letters")
    return F.col("neg_log_prob") / F.greatest(n, F.lit(1))


def _class(languages):
    lang = F.col("lang")
    return F.when(lang.isin(*languages), lang).otherwise(F.lit("other"))


def bands(measured: DataFrame, languages: tuple[str, ...] = LANGUAGES, fences: dict[str, float] = FENCES,
          min_docs: int = 20) -> dict[str, dict[str, tuple[float, float]]]:
    """Per language class and unit, (lower, upper) log-perplexity; at most languages + 2 rows. A class
    with fewer than ``min_docs`` documents gets the bands of all classes together."""
    quartiles = [F.percentile_approx(_log_ppl(u), [0.25, 0.75], 10000).alias(u) for u in fences]
    rows = (measured.filter(~_base_failed()).rollup(_class(languages).alias("c"))
            .agg(F.count("*").alias("n"), *quartiles))
    out = {}
    for r in rows.collect():
        if r["n"] >= min_docs:
            out[r["c"]] = {}
            for u, fence in fences.items():
                lo, hi = r[u]
                wide = fence * max(hi - lo, LEAST_RANGE[u])
                out[r["c"]][u] = (lo - wide, hi + wide)
    pooled = out.pop(None, None)
    return out if pooled is None else {c: out.get(c, pooled) for c in (*languages, "other")}


def _kept(limits: dict[str, dict[str, tuple[float, float]]], languages):
    inside = F.lit(True)
    for c, units in limits.items():
        fits = F.lit(True)
        for u, (lo, hi) in units.items():
            fits = fits & _log_ppl(u).between(lo, hi)
        inside = F.when(_class(languages) == c, fits).otherwise(inside)
    return ~_base_failed() & inside


def quality_report(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES,
                   fences: dict[str, float] = FENCES) -> DataFrame:
    """doc_id, lang, the counts, both log-perplexities, base_failed and kept of every document."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit_model(docs, languages))
    measured = materialize(project_columns(docs, ["doc_id", "lang"], ["text", "lang"], _STATS,
                                           _measurer(model, languages)), "quality")
    limits = bands(measured, languages, fences)
    return (measured.withColumn("base_failed", _base_failed()).withColumn("log_ppl_word", _log_ppl("word"))
            .withColumn("log_ppl_letter", _log_ppl("letter")).withColumn("kept", _kept(limits, languages))
            .drop("neg_log_prob", "n_letters"))


def quality_filter(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES,
                   fences: dict[str, float] = FENCES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit_model(docs, languages))
    prefix = "_q_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    measure = _measurer(model, languages)
    measured = project_columns(docs, ["lang"], ["text", "lang"], _STATS, measure)
    limits = bands(measured, languages, fences)
    fields = [T.StructField(prefix, T.BooleanType())]

    def make():
        fn, where = measure(), _language_index(languages)
        names = (*languages, "other")

        def judge(texts, langs):
            n, _, _, _, repeats, cost, letters = fn(texts, langs)
            out = []
            for i, x in enumerate(langs):
                ok = n[i] >= 50 and 100 * repeats[i] <= 50 * n[i]
                for unit, (lo, hi) in limits.get(names[where(x)], {}).items():
                    ok = ok and lo <= cost[i] / max(n[i] if unit == "word" else letters[i], 1) <= hi
                out.append(bool(ok))
            return [out]
        return judge
    return append_columns(docs, ["text", "lang"], fields, make).filter(F.col(prefix)).drop(prefix)
