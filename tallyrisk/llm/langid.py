"""Language identification by Bayesian evidence fusion (operator 2).

Evidence per row: (1) the text: a naive Bayes model over hashed character trigrams of words,
counted by Spark from all labelled documents; (2) the declared markup language; (3) the address
suffix; (4) a host prior shrunk host -> registered domain -> all rows. (2)-(4) are grouped
aggregations of the rows' own text-only verdicts; their tables are small per key and never held
by one task. Text evidence is tempered (``tempering`` equivalent words at most), since naive
Bayes over a long text would drown every other source.

Defined results: an empty, null or letterless text has flat text evidence; a row without host,
suffix or declared language takes no evidence from it; ties go to the language first in name
order; a posterior below ``threshold`` gives ``lang`` null (rejected), as does a row with no
text evidence at all; repeated rows get equal results; an empty table an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrisk.llm.common import (append_columns, chunks, guarded, index_words, map_arrow, materialize,
                                  project_columns, sum_by_text)

LANGUAGES = ("de", "en", "es", "fr")
BUCKETS = 1 << 14        # hashed trigram features: the model is languages x BUCKETS numbers
TEMPERING = 4.0          # words of text evidence at most
THRESHOLD = 0.65
WORDS_AT_ONCE = 50_000   # distinct words whose features are spelled out together
DECLARED_STRENGTH = 20.0  # pseudo-rows of the symmetric prior behind P(declared | language)
HOST_STRENGTH = 10.0      # pseudo-rows a level takes from the level above


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of letters (edges included) and the word each belongs to."""
    text = "\n" + (b"\n".join(words)).decode().lower() + "\n"
    a = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.cumsum(a[:-2] == 10) - 1 if len(a) > 2 else np.zeros(0, np.int64)
    mid = a[1:-1]
    # a trigram counts only around a letter; letters are ASCII letters and all above U+00BF
    letter = ((mid >= 97) & (mid <= 122)) | (mid > 0xBF)
    h = (a[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ mid * np.uint64(0xC2B2AE3D27D4EB4F)
         ^ a[2:] * np.uint64(0x165667B19E3779F9))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    bucket = (h >> np.uint64(40)).astype(np.int64) % BUCKETS
    return bucket[letter], word[letter]


def count_features(docs: DataFrame, languages=LANGUAGES, text="text", lang="lang") -> DataFrame:
    """(lang_bucket, n): trigram counts of every labelled text."""
    def run(batches):
        total = np.zeros((len(languages), BUCKETS), np.int64)
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in chunks(texts):
                for li, name in enumerate(languages):
                    words, ids, _ = index_words([t if x == name else None
                                                 for t, x in zip(texts[lo:hi], langs[lo:hi])])
                    n = np.bincount(ids, minlength=len(words))
                    for at in range(0, len(words), WORDS_AT_ONCE):
                        bucket, word = word_features(words[at:at + WORDS_AT_ONCE])
                        total[li] += np.bincount(bucket, n[at + word], BUCKETS).astype(np.int64)
        keys = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total.ravel()[keys])], names=["k", "n"])
    labelled = docs.filter(F.col(lang).isin(*languages)).select(text, lang)
    return map_arrow(labelled, run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))


def fit_text_model(docs: DataFrame, languages=LANGUAGES) -> np.ndarray:
    """Log-likelihoods, languages x BUCKETS (that product bounds what the driver gathers)."""
    table = count_features(docs, languages).toArrow()
    c = np.full(len(languages) * BUCKETS, 0.5)
    c[table.column("k").to_numpy()] += table.column("n").to_numpy()
    c = c.reshape(len(languages), BUCKETS)
    return np.log(c / c.sum(axis=1, keepdims=True)).astype(np.float32)


def text_evidence(model, tempering: float = TEMPERING):
    """make() for append/project_columns: tempered log-likelihoods of a text; null without letters."""
    def make():
        weights = model.value.T

        def fn(texts):
            words, ids, offsets = index_words(texts)
            if not words:
                return [[None] * len(texts)]
            score = np.zeros((len(words), weights.shape[1]))
            lettered = np.zeros(len(words), bool)
            for at in range(0, len(words), WORDS_AT_ONCE):
                part = slice(at, min(at + WORDS_AT_ONCE, len(words)))
                bucket, word = word_features(words[part])
                size = part.stop - at
                for k in range(weights.shape[1]):
                    score[part, k] = np.bincount(word, weights[bucket, k], size)
                lettered[part] = np.bincount(word, minlength=size) > 0
            n = sum_by_text(lettered[ids].astype(float), offsets)
            out = []
            for i in range(len(texts)):
                if not n[i]:
                    out.append(None)
                    continue
                s = score[ids[offsets[i]:offsets[i + 1]]].sum(axis=0)
                s *= min(1.0, tempering / n[i])
                out.append((s - s.max()).tolist())
            return [out]
        return fn
    return make


_EVIDENCE = T.StructField("_ll", T.ArrayType(T.DoubleType()))


def _soft(arr: Column) -> Column:
    e = F.transform(arr, lambda x: F.exp(x))
    total = F.aggregate(e, F.lit(0.0), lambda s, x: s + x)
    return F.transform(e, lambda x: x / total)


def _sums(n: int, weights: str = "_w"):
    """Sum of a probability array, slot by slot."""
    return F.array(*[F.coalesce(F.sum(F.col(weights)[i]), F.lit(0.0)) for i in range(n)])


def _numbers(values) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def _total(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda s, x: s + x)


def _shrink(counts: str, parent: str, strength: float) -> Column:
    own = _total(F.col(counts))
    return F.zip_with(F.col(counts), F.col(parent), lambda c, p: (c + strength * p) / (own + strength))


def fuse(rows: DataFrame, keys: list[str], languages=LANGUAGES, threshold: float = THRESHOLD) -> DataFrame:
    """rows: keys, _ll, declared, suffix, domain, host -> keys, lang, posterior, posteriors."""
    n = len(languages)
    flat = F.array(*[F.lit(1.0 / n)] * n)
    rows = rows.withColumn("_w", F.when(F.col("_ll").isNotNull(), _soft(F.col("_ll"))))
    voted = rows.filter("_w is not null")
    # Language mass of all rows, and of the rows with a declared language or a suffix: 3 n numbers.
    seen = {None: F.lit(True), "declared": F.col("declared").isNotNull(), "suffix": F.col("suffix").isNotNull()}
    totals = voted.agg(*[F.array(*[F.coalesce(F.sum(F.when(test, F.col("_w")[i])), F.lit(0.0))
                                   for i in range(n)]).alias(str(name)) for name, test in seen.items()]).first()

    def likelihood(column: str):
        """P(value | language), one array per value, smoothed towards independence."""
        own = voted.filter(F.col(column).isNotNull()).groupBy(column).agg(_sums(n).alias("_c"))
        total = totals[column]
        mass = _total(F.col("_c")) / max(sum(total), 1e-9)
        return own.select(column, F.zip_with("_c", _numbers(total), lambda c, t: (c + DECLARED_STRENGTH * mass)
                                             / (t + DECLARED_STRENGTH)).alias(f"_l_{column}"))
    host = voted.filter("host is not null").groupBy("host").agg(
        F.min("domain").alias("domain"), _sums(n).alias("_c"))
    domain = host.groupBy("domain").agg(_sums(n, "_c").alias("_d"))
    everywhere = _numbers([(x + 1) / (sum(totals["None"]) + n) for x in totals["None"]])
    prior = (host.join(domain.withColumnRenamed("domain", "_dom"), F.col("domain").eqNullSafe(F.col("_dom")))
             .withColumn("_p0", everywhere).withColumn("_p1", _shrink("_d", "_p0", HOST_STRENGTH))
             .select("host", _shrink("_c", "_p1", HOST_STRENGTH).alias("_prior")))
    # A table of its own, so that the join below can split a hot host (or broadcast a small table).
    prior = materialize(prior, "host-priors")
    out = (rows.join(prior, "host", "left").join(likelihood("declared"), "declared", "left")
           .join(likelihood("suffix"), "suffix", "left"))
    log = lambda c: F.transform(F.coalesce(F.col(c), flat), lambda x: F.log(x))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    score = add(add(F.coalesce(F.col("_ll"), F.transform(flat, lambda x: x * 0)), log("_prior")),
                add(log("_l_declared"), log("_l_suffix")))
    out = out.withColumn("_s", score).withColumn("_s", F.transform("_s", lambda x: x - F.array_max("_s")))
    out = out.withColumn("posteriors", _soft(F.col("_s")))
    names = F.array(*map(F.lit, languages))
    best = F.array_position("posteriors", F.array_max("posteriors")).cast("int")
    return out.select(*keys, F.element_at(names, best).alias("best"), F.array_max("posteriors").alias("posterior"),
                      "posteriors", F.col("_ll").isNotNull().alias("has_text")).withColumn(
        "lang", F.when(F.col("has_text") & (F.col("posterior") >= threshold), F.col("best")))


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """host, registered domain (last two labels) and suffix (last label) of a url."""
    host = F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1))
    host = F.when(host != "", host)
    labels = F.split(host, r"\.")
    domain = F.when(F.size(labels) >= 2, F.concat_ws(".", F.slice(labels, -2, 2))).otherwise(host)
    return host, domain, F.element_at(labels, -1)


def declared_language(html: Column) -> Column:
    """Primary subtag of the page's ``<html lang=...>``; null where there is none."""
    tag = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]+)", 1))
    return F.when(tag != "", tag)


def visible_text(html: Column) -> Column:
    """Rough text for language evidence: no scripts, styles, comments, tags or references."""
    s = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(s, r"<[^>]*>|&[#\w]+;", " ")


def identify_pages(pages: DataFrame, labelled: DataFrame, languages=LANGUAGES,
                   threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url, declared, host, best, posterior, posteriors, lang for every page."""
    model = pages.sparkSession.sparkContext.broadcast(fit_text_model(labelled, languages))
    host, domain, suffix = split_url(F.col("url"))
    src = pages.select("page_id", "url", host.alias("host"), domain.alias("domain"), suffix.alias("suffix"),
                       declared_language(F.col("html")).alias("declared"), visible_text(F.col("html")).alias("_t"))
    keep = ["page_id", "url", "host", "domain", "suffix", "declared"]
    rows = materialize(project_columns(src, keep, ["_t"], [_EVIDENCE], text_evidence(model)), "langid")
    return fuse(rows, ["page_id", "url", "declared", "host"], languages, threshold)


@guarded("text", "lang", "source")
def language_filter(docs: DataFrame, languages=LANGUAGES, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose language is found, with their own columns: ``lang`` counts as the declared
    language and ``source`` as the host. A row is rejected when the fused posterior stays under
    ``threshold`` or the text holds no letters."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit_text_model(docs, languages))
    src = docs.select(F.col("lang").alias("declared"), F.col("source").alias("host"), F.col("text").alias("_t"))
    rows = project_columns(src, ["declared", "host"], ["_t"], [_EVIDENCE], text_evidence(model))
    # The priors need sums per (declared, host) only: gathered first ...
    weight = _soft(F.col("_ll"))
    pairs = materialize(rows.groupBy("declared", "host").agg(F.array(*[
        F.coalesce(F.sum(weight[i]), F.lit(0.0)) for i in range(len(languages))]).alias("_w")), "langid")
    prior = materialize(_pair_priors(pairs, len(languages)), "pair-priors")
    # ... and joined to the documents by (lang, source); the text decides within the pair.
    left = append_columns(docs, ["text"], [_EVIDENCE], text_evidence(model))
    joined = left.join(prior, left["lang"].eqNullSafe(prior["_declared"])
                       & left["source"].eqNullSafe(prior["_host"]), "left")
    score = F.zip_with("_ll", "_lp", lambda x, y: x + y)
    best = F.array_max(_soft(F.transform(score, lambda x: x - F.array_max(score))))
    return joined.filter(F.col("_ll").isNotNull() & (best >= threshold)).select(
        *[left[f"`{c}`"] for c in docs.columns])


def _pair_priors(pairs: DataFrame, n: int) -> DataFrame:
    """log prior + declared likelihood per (declared, host) pair of a document table."""
    total = pairs.agg(_sums(n).alias("t")).first()["t"]
    everywhere = _numbers([(x + 1) / (sum(total) + n) for x in total])
    host = pairs.groupBy("host").agg(_sums(n).alias("_c")).withColumn("_p0", everywhere).select(
        F.col("host").alias("_h"), _shrink("_c", "_p0", HOST_STRENGTH).alias("_prior"))
    said = pairs.groupBy("declared").agg(_sums(n).alias("_c"))
    share = _total(F.col("_c")) / max(sum(total), 1e-9)
    said = said.select(F.col("declared").alias("_d"), F.zip_with(
        "_c", _numbers(total), lambda c, t: (c + DECLARED_STRENGTH * share) / (t + DECLARED_STRENGTH)
    ).alias("_like"))
    flat = F.array(*[F.lit(1.0 / n)] * n)
    out = (pairs.join(host, pairs["host"].eqNullSafe(host["_h"]), "left")
           .join(said, pairs["declared"].eqNullSafe(said["_d"]), "left"))
    like = F.when(F.col("declared").isNotNull(), F.col("_like")).otherwise(flat)
    prior = F.when(F.col("host").isNotNull(), F.col("_prior")).otherwise(flat)
    return out.select(F.col("declared").alias("_declared"), F.col("host").alias("_host"),
                      F.zip_with(like, prior, lambda a, b: F.log(a) + F.log(b)).alias("_lp"))
