"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.llm import (bpe, chat, decontam, divergence, host_rep, html_extract, langid, lm_score, mix, negatives,
                           quality, shard, simhash)
from tallyrisk.llm.common import read

TOKENIZER = os.environ.get("TOKENIZER_JSON", "")


def tokenizer_path() -> str:
    """The byte-level BPE file: ``TOKENIZER_JSON`` or the installed public one."""
    if TOKENIZER:
        return TOKENIZER
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_pages(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))


def rotation_digest(rotated: DataFrame) -> DataFrame:
    """Masks as text: start-end, comma-joined."""
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return rotated.withColumn("mask", F.concat_ws(",", spans))


def op3_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotation_digest(chat.rotate(read(spark, sf_dir, "conversations")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read(spark, sf_dir, "documents"))


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, bad: a page shows the document whose id is the number in its path; the outcome is bad
    where that document is labelled low quality or toxic."""
    _, path = host_rep.host_and_path(F.col("url"))
    number = F.regexp_extract(path, r"^/[a-z]+/(\d{1,18})", 1)
    pages = read(spark, sf_dir, "pages").select("page_id", number.alias("n"))
    pages = pages.select("page_id", F.when(F.col("n") != "", F.col("n")).cast("long").alias("doc_id"))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    return pages.join(read(spark, sf_dir, "labels").select("doc_id", bad.alias("bad")), "doc_id").select(
        "page_id", "bad")


def op5_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rep.judge_urls(read(spark, sf_dir, "pages"), page_outcomes(spark, sf_dir))


def op6_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.interleave(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(read(spark, sf_dir, "documents"), tokenizer_path())


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(read(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


def op11_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix_report(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_main_text, op2_language_id, op3_chat_rotation, op4_quality_rules, op5_host_reputation, op6_interleaved_shards,
    op7_decontamination, op8_bpe, op9_lm_score, op10_simhash, op11_fair_mix, op12_source_divergence,
    op13_hard_negatives)}

_ROTATE = """
WITH t AS (
  SELECT conv_id, turn, role, text, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1) // 256 AS part
  FROM (SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
        FROM conversations)),
s AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
p AS (
  SELECT t.conv_id, s.perspective, t.part, t.turn, t.role, t.text,
         '<|im_start|>' || CASE WHEN t.role = s.perspective THEN 'assistant' WHEN t.role = 'system' THEN 'system'
                                ELSE 'user name=' || t.role END || chr(10) AS head,
         t.text || '<|im_end|>' AS body
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
q AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
      PARTITION BY conv_id, perspective ORDER BY part, turn, role, text
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM p)
SELECT conv_id, perspective, CAST(part AS INTEGER) AS part, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY turn, role, text) AS rendered,
       coalesce(string_agg(CASE WHEN role = perspective THEN CAST(before + length(head) AS BIGINT) || '-'
                           || CAST(before + length(head) + length(body) AS BIGINT) END, ',' ORDER BY turn, role, text),
                '') AS mask
FROM q GROUP BY conv_id, perspective, part
"""

_REPUTATION = """
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
o AS (
  SELECT u.page_id, u.host, u.path, l.bad FROM u LEFT JOIN (
    SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
    WHERE quality IS NOT NULL OR toxic = 1 GROUP BY doc_id) l
  ON TRY_CAST(nullif(regexp_extract(u.path, '^/[a-z]+/([0-9]{1,18})', 1), '') AS BIGINT) = l.doc_id),
h AS (SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
             string_split(host, '.')[-1] AS suffix, count(bad) AS n, coalesce(sum(bad), 0) AS bad
      FROM o GROUP BY host),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix),
s0 AS (SELECT suffix, n, bad, (2.0::DOUBLE * 0.5 + (SELECT sum(bad) FROM h) - bad) / known AS prior, known
       FROM (SELECT suffix, sum(n) AS n, sum(bad) AS bad, 2.0::DOUBLE + (SELECT sum(n) FROM h) - sum(n) AS known
             FROM d GROUP BY suffix)),
s1 AS (SELECT *, {strength} * known / ({strength} + known) AS k FROM s0),
d0 AS (SELECT d.domain, d.n, d.bad, s1.k + s1.n - d.n AS known,
              (s1.k * s1.prior + s1.bad - d.bad) / (s1.k + s1.n - d.n) AS prior FROM d JOIN s1 USING (suffix)),
d1 AS (SELECT *, {strength} * known / ({strength} + known) AS k FROM d0),
h0 AS (SELECT h.host, h.n, h.bad, d1.k + d1.n - h.n AS known,
              (d1.k * d1.prior + d1.bad - h.bad) / (d1.k + d1.n - h.n) AS prior FROM h JOIN d1 USING (domain)),
h1 AS (SELECT *, {strength} * known / ({strength} + known) AS k FROM h0),
h2 AS (SELECT host, k + n AS total, (k * prior + bad) / (k + n) AS mean FROM h1),
r AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (total + 1)) AS bound FROM h2),
j AS (
  SELECT u.*, r.bound, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM u LEFT JOIN r USING (host))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict, round(bound, 6) AS bad_bound
FROM j
"""
# Moment estimate of a level's prior strength, as a scalar over the level's labelled groups.
_STRENGTH = """(SELECT CASE WHEN coalesce(t, 0) = 0 OR g < 2 OR v = 0 THEN 1.0
    ELSE CASE WHEN share <= 1.0 / 1001 THEN 1000.0 WHEN share >= 0.5 THEN 1.0 ELSE 1 / share - 1 END END
  FROM (SELECT *, ((sq - (g - 1) * (v / t)) / greatest(t - n2 / t, 1e-9)) / (v / t) AS share FROM (
    SELECT CAST(sum(n) AS DOUBLE) AS t, CAST(sum(n * n) AS DOUBLE) AS n2, count(*) AS g,
           sum(n * (bad / n::DOUBLE - prior) * (bad / n::DOUBLE - prior)) AS sq, sum(n * prior * (1 - prior)) AS v
    FROM {level} WHERE n > 0)))::DOUBLE"""


def _reputation_sql() -> str:
    sql = _REPUTATION
    for level in ("s0", "d0", "h0"):
        sql = sql.replace("{strength}", _STRENGTH.replace("{level}", level), 2)
    return sql


_DECONTAMINATION = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
             regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bi AS (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bl),
g AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM bi),
dn AS (SELECT doc_id, w, n FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dn),
hit AS (SELECT doc_id, i, di.n, item FROM di JOIN g ON array_to_string(w[i:i + di.n - 1], ' ') = gram AND di.n = g.n),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_MIX = r"""
WITH r AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
           FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) - 1 AS copy FROM r),
k AS (SELECT *, CAST('0x' || substr(md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || size || '|' || copy), 1, 15)
                     AS BIGINT) AS h FROM d),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS LAST) AS place, CAST(sum(size) AS BIGINT) AS source_size
      FROM k GROUP BY source),
w AS (SELECT *, [5, 2, 1][(place - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM s),
b AS (SELECT CAST(sum(source_size) AS BIGINT) AS budget, CAST(sum(weight) AS BIGINT) AS weights FROM w),
f AS (SELECT *, CAST(coalesce(sum(cap) OVER before, 0) AS BIGINT) AS cap_before,
             CAST(coalesce(sum(weight) OVER before, 0) AS BIGINT) AS weight_before
      FROM w WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max((budget - cap_before)::DOUBLE / (weights - weight_before)::DOUBLE) AS level FROM f, b),
t AS (SELECT w.*, least(cap::DOUBLE, level * weight) AS target FROM w, l),
q AS (SELECT k.*, t.place, t.source_size, t.target,
             CAST(sum(size) OVER (PARTITION BY t.place ORDER BY h, k.doc_id NULLS FIRST, size, copy
                                  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sent
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, unnest(range(1, CASE WHEN source_size = 0 THEN 2
                                ELSE 2 + least(2, CAST(floor(target / source_size) AS BIGINT)) END)) AS epoch FROM q),
v AS (SELECT *, CASE WHEN target > 0 THEN ((epoch - 1) * source_size + sent)::DOUBLE / target
                ELSE 'infinity'::DOUBLE END AS finish FROM e),
c AS (SELECT *, sum(size) OVER (ORDER BY finish, place, h, doc_id NULLS FIRST, size, copy, epoch
                                ROWS UNBOUNDED PRECEDING) AS total FROM v)
SELECT doc_id, size, any_value(source_size) AS source_size, any_value(target) AS target,
       CAST(coalesce(sum(size) FILTER (total <= budget), 0) AS BIGINT) AS taken
FROM c, b GROUP BY doc_id, source, size, copy
"""

_DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
x AS (SELECT row, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM x GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM x JOIN k USING (lang, term) GROUP BY lang, source, term),
l AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT d.lang, d.source, coalesce(any_value(s.total), 0) AS total, coalesce(any_value(l.v), 0) AS v
      FROM d LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) s USING (lang, source)
      LEFT JOIN l USING (lang) GROUP BY d.lang, d.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p
      FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item,
                 CAST(coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
          LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
q AS (SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q FROM k JOIN l USING (lang)),
terms AS (SELECT p.lang, p.source, p.term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value
          FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)
        AS rank FROM pairs
      UNION ALL SELECT * FROM (
        SELECT lang, source, 'term' AS part, item, value,
               row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms) WHERE rank <= 200)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM r
"""

_NEGATIVES = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
       AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""

ORACLE: dict[str, str] = {"op3_chat_rotation": _ROTATE, "op5_host_reputation": _reputation_sql(),
                          "op7_decontamination": _DECONTAMINATION, "op11_fair_mix": _MIX,
                          "op12_source_divergence": _DIVERGENCE, "op13_hard_negatives": _NEGATIVES}
