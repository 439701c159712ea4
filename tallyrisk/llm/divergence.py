"""Divergence of the sources of a language from each other and from the language (operator 12).

The method is a count vectorizer per language (document frequency of ``min_df`` at least, vocabulary
without a limit), sparse count vectors, group sums, and the evaluation of pairs of sparse sums.
``pyspark.ml``'s CountVectorizer brings its whole vocabulary to the driver and broadcasts it, and
that has no bound here; so the vocabulary stays a distributed table, and a document's vector is
the rows (group, term, count) that a task makes of it and of the task's other documents.

Counting. A task cuts its texts into terms, numbers the distinct terms it has seen and keeps, per
(group, term), occurrences and documents; it passes them on when its dictionary reaches
``PENDING_BYTES``. Spark adds them up over tasks. A term's documents over all sources of a language
decide whether it is in the vocabulary.

Evaluation. With ``V`` kept terms and ``N`` occurrences of them in a group, every kept term has
``p = 1 + floor(10^9 (count + 1) / (N + V))`` there, so all terms that a group lacks share one p. A
pair of groups needs the terms that either holds; what both lack is a product. Terms go to blocks by
hash, never by language or source; a block gets the nonzero counts of its terms and the list of the
language's groups, and gives the partial sum of every pair, which Spark adds up. All is integer
arithmetic.

Defined results: null texts, languages and sources are empty strings; repeated documents count as
often as they occur; a group without terms has count 0 everywhere; a language without kept terms
has pairs of value 0 and no term rows; a language with one source has no pairs; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyrisk.llm.common import chunks, map_arrow, materialize

MIN_DF = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
PENDING_BYTES = 24 << 20   # of distinct terms a counting task holds before it passes them on
PENDING_PAIRS = 2_000_000  # (group, term) entries likewise
BLOCK_COUNTS = 400_000     # nonzero counts of a block of terms, about
EXACT_COUNT = 9_000_000_000   # (count + 1) * SCALE fits a long below this
# Upper-case ASCII becomes lower case; every other ASCII character that is no letter, a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class _Counter:
    """Occurrences and documents of (group, term) in a task's texts."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.terms: dict[bytes, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.bytes = 0
        self.keys, self.n, self.df = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, texts: list, langs: list, sources: list) -> None:
        terms, ids, docs = self.terms, [], []
        group = np.empty(len(texts), np.int64)
        for i, (text, pair) in enumerate(zip(texts, zip(langs, sources))):
            words = text.encode().translate(_FOLD).split() if text else []
            group[i] = self.groups.setdefault(pair, len(self.groups))
            for w in set(words).difference(terms):
                terms[w] = len(terms)
                self.bytes += len(w) + 80
            ids.append(np.fromiter(map(terms.__getitem__, words), np.int64, len(words)))
            docs.append(len(words))
        ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(texts)), docs)
        seen, n = np.unique(doc << 40 | ids, return_counts=True)    # (document, term)
        keys = group[seen >> 40] << 40 | seen & (1 << 40) - 1       # (group, term)
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        n = np.concatenate([self.n, n])[order]
        df = np.concatenate([self.df, np.ones(len(seen), np.int64)])[order]
        self.keys = keys[first]
        self.n = np.add.reduceat(n, first) if len(first) else n
        self.df = np.add.reduceat(df, first) if len(first) else df

    def full(self) -> bool:
        return self.bytes > PENDING_BYTES or len(self.keys) > PENDING_PAIRS

    def flush(self):
        names = pa.array([w.decode() for w in self.terms], pa.string())
        langs = pa.array([g[0] for g in self.groups], pa.string())
        sources = pa.array([g[1] for g in self.groups], pa.string())
        # A row without a term says that the group occurs.
        yield pa.RecordBatch.from_arrays(
            [langs, sources, pa.nulls(len(langs), pa.string()), *[pa.array(np.zeros(len(langs), np.int64))] * 2],
            names=["lang", "source", "term", "n", "df"])
        for lo in range(0, len(self.keys), 100_000):
            keys = self.keys[lo:lo + 100_000]
            g, t = pa.array(keys >> 40), pa.array(keys & (1 << 40) - 1)
            yield pa.RecordBatch.from_arrays(
                [langs.take(g), sources.take(g), names.take(t), pa.array(self.n[lo:lo + 100_000]),
                 pa.array(self.df[lo:lo + 100_000])], names=["lang", "source", "term", "n", "df"])
        self.clear()


def group_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), df (documents); a row with a null term per group."""
    def run(batches):
        counter = _Counter()
        for b in batches:
            texts, langs, sources = (b.column(i).to_pylist() for i in range(3))
            for lo, hi in chunks(texts):
                counter.add(texts[lo:hi], langs[lo:hi], sources[lo:hi])
                if counter.full():
                    yield from counter.flush()
        yield from counter.flush()
    src = docs.select("text", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    parts = map_arrow(src, run, "lang string, source string, term string, n long, df long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _scaled(count, total):
    """1 + floor(SCALE (count + 1) / total), exact for any count."""
    wide = f"(cast({SCALE} as decimal(12,0)) * cast({count} + 1 as decimal(20,0))) div cast({total} as decimal(20,0))"
    return F.expr(f"1 + case when {total} = 0 then 0 when {count} < {EXACT_COUNT}L then ({SCALE}L * ({count} + 1)) div {total} "
                  f"else {wide} end").cast("long")


class Audit:
    """Kept counts, groups and languages of a corpus, written once and read by both parts."""

    def __init__(self, docs: DataFrame, min_df: int = MIN_DF):
        counts = materialize(group_counts(docs), "audit-counts")
        terms = counts.filter(F.col("term").isNotNull())
        vocabulary = terms.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("n_lang"))
        vocabulary = materialize(vocabulary.filter(F.col("df") >= min_df).select("lang", "term", "n_lang"), "audit-terms")
        kept = terms.select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"])
        self.kept = materialize(kept, "audit-kept")
        self.langs = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("total_lang"))
        sums = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = counts.select("lang", "source").filter("term is null").join(sums, ["lang", "source"], "left")
        groups = groups.join(self.langs, "lang", "left")
        zero = F.lit(0).cast("long")
        self.groups = materialize(groups.select(
            "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("v", zero).alias("v"),
            F.coalesce("total_lang", zero).alias("total_lang")), "audit-groups")

    def term_rows(self, top: int = TOP_TERMS) -> DataFrame:
        """Per group its terms that are more frequent than in the language, most divergent first."""
        rows = self.kept.join(self.groups, ["lang", "source"])
        rows = rows.withColumn("tp", F.col("total") + F.col("v")).withColumn("tq", F.col("total_lang") + F.col("v"))
        rows = rows.select("lang", "source", "term", _scaled("n", "tp").alias("p"), _scaled("n_lang", "tq").alias("q"))
        rows = rows.filter(F.col("p") > F.col("q")).withColumn("value", F.expr("((p - q) * (p - q)) div q"))
        best = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("term"))
        return (rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
                .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))

    def pair_rows(self, block_counts: int = BLOCK_COUNTS) -> DataFrame:
        """Every ordered pair of sources of a language with the sum over all its kept terms."""
        blocks = 1 + self.kept.count() // block_counts
        counts = self.kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"),
                                  "source", "term", "n")
        zero = F.lit(0).cast("long")
        counts = counts.join(self.groups.select("lang", "source", "total", "v"), ["lang", "source"])
        counts = counts.withColumn("t", F.col("total") + F.col("v")).select(
            "lang", "block", "source", "term", _scaled("n", "t").alias("p"))
        every = self.groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        every = every.withColumn("t", F.col("total") + F.col("v")).withColumn("none", zero).select(
            "lang", "block", "source", F.lit(None).cast("string").alias("term"), _scaled("none", "t").alias("p"))
        parts = counts.unionByName(every).groupBy("lang", "block").applyInArrow(
            _pair_sums, "lang string, source string, item string, value long")
        sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
        return sums.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                           F.row_number().over(order).alias("rank"))


def _divergence(p, q):
    d = p - q
    return d * d // q


def pair_sums(source: np.ndarray, term: np.ndarray, p: np.ndarray, absent: np.ndarray, n_terms: int) -> np.ndarray:
    """Sums over ``n_terms`` terms of floor((p - q)^2 / q) for every ordered pair of sources.

    ``source``, ``term``, ``p``: the nonzero entries, sorted by source; ``absent``: per source the p of
    a term it lacks. An entry of the second source meets the first source's p of that term; the first
    source's other entries meet the second's ``absent``; the terms both lack are counted.
    """
    k = len(absent)
    out = np.zeros((k, k), np.int64)
    bounds = np.searchsorted(source, np.arange(k + 1))
    size = np.diff(bounds)
    live = np.flatnonzero(size)
    for g in range(k):
        lo, hi = bounds[g], bounds[g + 1]
        mine = np.full(n_terms, absent[g], np.int64)
        mine[term[lo:hi]] = p[lo:hi]
        have = np.zeros(n_terms, bool)
        have[term[lo:hi]] = True
        both, value, shared = np.zeros(k, np.int64), np.zeros(k, np.int64), have[term]
        if len(live):
            value[live] = np.add.reduceat(_divergence(mine[term], p), bounds[live])
            both[live] = np.add.reduceat(shared.astype(np.int64), bounds[live])
        # Entries of g alone: all of g's against the other's absent p, less those that the other has.
        levels, at = np.unique(absent, return_inverse=True)
        whole = np.array([_divergence(p[lo:hi], q).sum() for q in levels], np.int64)[at]
        if len(live):
            taken = np.where(shared, _divergence(mine[term], absent[source]), 0)
            whole[live] -= np.add.reduceat(taken, bounds[live])
        neither = n_terms - size[g] - size + both
        out[g] = value + whole + neither * _divergence(absent[g], absent)
    return out


def _pair_sums(table: pa.Table) -> pa.Table:
    lang = table.column("lang")[0].as_py()
    term = table.column("term").combine_chunks()
    listed = term.is_null().to_numpy(zero_copy_only=False)
    source = table.column("source").combine_chunks()
    p = table.column("p").to_numpy()
    names = source.filter(pa.array(listed))
    order = np.argsort(np.array(names.to_pylist(), object), kind="stable")
    names = names.take(pa.array(order))
    absent = p[listed][order]
    place = {s: i for i, s in enumerate(names.to_pylist())}
    codes = term.filter(pa.array(~listed)).dictionary_encode()
    held = source.filter(pa.array(~listed)).dictionary_encode()
    at = np.array([place[s] for s in held.dictionary.to_pylist()], np.int64)[held.indices.to_numpy()] \
        if len(held) else np.zeros(0, np.int64)
    order = np.argsort(at, kind="stable")
    sums = pair_sums(at[order], codes.indices.to_numpy().astype(np.int64)[order], p[~listed][order], absent,
                     len(codes.dictionary))
    k = len(absent)
    first, second = np.divmod(np.arange(k * k), max(k, 1))
    other = first != second
    first, second = pa.array(first[other]), pa.array(second[other])
    return pa.table({"lang": pa.array([lang] * len(first), pa.string()), "source": names.take(first),
                     "item": names.take(second), "value": pa.array(sums.ravel()[other])})


def source_divergence(docs: DataFrame, min_df: int = MIN_DF, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: the pairs and the leading terms of every group."""
    audit = Audit(docs, min_df)
    return audit.pair_rows().unionByName(audit.term_rows(top))
