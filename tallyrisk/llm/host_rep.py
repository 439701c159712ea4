"""Empirical-Bayes host reputation and path rules (operator 5).

Labelled page outcomes (1 bad, 0 good) are counted per host, registered domain (last two labels)
and suffix (last label). Each group's beta prior is the posterior of the group above without the
group's own outcomes; its strength combines how much that posterior knows with how alike the
level's groups are (moment estimator for beta-binomial counts). A host is blocked when the lower
posterior bound of its bad share exceeds ``max_bad``; hosts without evidence keep their domain's
prior, whose wide bound allows them. Rules (host, path prefix) override the reputation; the longest fitting rule wins.

Defined results: a null url or one without "://" has empty host and path, fits no rule and is
judged by the prior of the empty domain; pages without a label add no evidence; repeated rows
count as often as they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.common import guarded, materialize

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
MAX_BAD = 0.5
Z = 1.645            # one-sided 95 % bound
STRENGTH = (1.0, 1000.0)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda i: F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict): the longest rule that fits; of equal lengths the first in text order."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame) -> float:
    """Prior strength from groups (n, bad, prior): moment estimate, clipped."""
    p = F.col("bad") / F.col("n")
    r = groups.filter("n > 0").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.count("*").alias("k"),
        F.sum(F.col("n") * (p - F.col("prior")) ** 2).alias("s"),
        F.sum(F.col("n") * F.col("prior") * (1 - F.col("prior"))).alias("v")).first()
    low, high = STRENGTH
    if not r["n"] or r["k"] < 2 or not r["v"]:
        return low
    within = r["v"] / r["n"]
    between = (r["s"] - (r["k"] - 1) * within) / max(r["n"] - r["n2"] / r["n"], 1e-9)
    share = between / within
    return high if share <= 1 / (high + 1) else low if share >= 1 / (low + 1) else 1 / share - 1


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """outcomes (host, bad: 1, 0 or null) -> host, n, bad, mean, bound for every host."""
    hosts = materialize(outcomes.groupBy("host").agg(F.count("bad").alias("n"),
                                                     F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "hosts")
    hosts = hosts.withColumn("domain", domain_of(F.col("host")))
    domains = hosts.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn(
        "suffix", suffix_of(F.col("domain")))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    top = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    suffixes = _shrunk(suffixes.withColumns({"up_n": F.lit(top["n"]), "up_bad": F.lit(top["bad"]),
                                             "up_mean": F.lit(0.5), "up_k": F.lit(2.0)}), "suffix")
    domains = _shrunk(_below(domains, suffixes, "suffix"), "domain")
    hosts = _shrunk(_below(hosts, domains, "domain"), "host")
    total = F.col("k") + F.col("n")
    hosts = hosts.withColumn("mean", (F.col("k") * F.col("prior") + F.col("bad")) / total)
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1))
    return hosts.select("host", "n", "bad", "mean", (F.col("mean") - Z * spread).alias("bound"))


def _below(level: DataFrame, above: DataFrame, link: str) -> DataFrame:
    return level.join(above.select(link, F.col("n").alias("up_n"), F.col("bad").alias("up_bad"),
                                   F.col("prior").alias("up_mean"), F.col("k").alias("up_k")), link)


def _shrunk(level: DataFrame, name: str) -> DataFrame:
    """Prior mean and strength k of each group from the group above (up_*), less the group itself."""
    bad = F.col("up_k") * F.col("up_mean") + F.col("up_bad") - F.col("bad")
    known = F.col("up_k") + F.col("up_n") - F.col("n")
    level = materialize(level.withColumn("prior", bad / known).withColumn("known", known).drop(
        "up_n", "up_bad", "up_mean", "up_k"), f"reputation-{name}")
    s = _strength(level)
    return level.withColumn("k", s * F.col("known") / (s + F.col("known")))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_bound of every page.

    ``outcomes``: page_id, bad (1 or 0); pages without one carry no evidence.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    # Evidence: labelled pages only; hosts without any are kept with zero counts.
    seen = outcomes.filter("bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    reputation = host_reputation(rows.join(seen, "page_id", "left").select("host", "bad"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > max_bad, "block").otherwise("allow")
    return rows.join(reputation.select("host", "bound"), "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        F.round("bound", 6).alias("bad_bound"))


@guarded("page_id", "url")
def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """The pages whose url is allowed, with their own columns."""
    judged = judge_urls(pages, outcomes, rules, max_bad).filter("verdict = 'block'").select(
        F.col("page_id").alias("_id"), F.col("host").alias("_h"), F.col("path").alias("_p")).distinct()
    host, path = host_and_path(F.col("url"))
    return pages.join(judged, F.col("page_id").eqNullSafe(F.col("_id")) & (host == F.col("_h"))
                      & (path == F.col("_p")), "left_anti")
