"""Queries: quantile edges, histogram, PSI, KS, feature / score drift, percentiles
(M-1..M-6, A-12, P-15) on lineitem before / from the cutoff and on ``v_score``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as D
from ..operators import sketches as S
from . import bindings as B
from .catalog import query
from .oracle_views import with_views

FEATS = B.DRIFT_FEATURES
_PROBS = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"


def _long(view: str, feats: list[str]) -> str:
    parts = [f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {view}" for f in feats]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE value IS NOT NULL AND NOT isnan(value)"


def _counts(view: str, feats: list[str], name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count({f}) FILTER (WHERE NOT isnan({f})) AS {name} FROM {view}"
        for f in feats)


def _drift_ctes(ref: str, cur: str, feats: list[str], p: str = "") -> dict[str, str]:
    """The drift statistics as CTEs (edges, bins, psi, ks per feature), names prefixed by ``p``."""
    n = {k: p + k for k in ["rl", "cl", "nr", "nc", "e", "rb", "cb", "ab", "hb", "ht", "ps",
                            "kv", "kc", "kd", "kx", "ks", "core"]}
    return {
        n["rl"]: _long(ref, feats),
        n["cl"]: _long(cur, feats),
        n["nr"]: _counts(ref, feats, "n_ref"),
        n["nc"]: _counts(cur, feats, "n_cur"),
        n["e"]: f"SELECT feature, list_sort(list_distinct(quantile_cont(value, {_PROBS}))) AS edges "
                f"FROM {n['rl']} GROUP BY feature",
        n["rb"]: f"SELECT l.feature, least(len(list_filter(e.edges, lambda x: x <= l.value)) - 1, len(e.edges) - 2) AS bin "
                 f"FROM {n['rl']} l JOIN {n['e']} e USING (feature) WHERE len(e.edges) >= 2 AND l.value >= e.edges[1] "
                 "AND l.value <= e.edges[len(e.edges)]",
        n["cb"]: f"SELECT l.feature, least(len(list_filter(e.edges, lambda x: x <= l.value)) - 1, len(e.edges) - 2) AS bin "
                 f"FROM {n['cl']} l JOIN {n['e']} e USING (feature) WHERE len(e.edges) >= 2 AND l.value >= e.edges[1] "
                 "AND l.value <= e.edges[len(e.edges)]",
        n["ab"]: f"SELECT feature, unnest(range(0, greatest(len(edges) - 1, 1))) AS bin, len(edges) AS n_edges FROM {n['e']}",
        n["hb"]: f"""SELECT ab.feature, ab.bin, ab.n_edges,
                   (SELECT count(*) FROM {n['rb']} r WHERE r.feature = ab.feature AND r.bin = ab.bin) AS rn,
                   (SELECT count(*) FROM {n['cb']} c WHERE c.feature = ab.feature AND c.bin = ab.bin) AS cn
                 FROM {n['ab']} ab""",
        n["ht"]: f"SELECT *, sum(rn) OVER (PARTITION BY feature) AS rt, sum(cn) OVER (PARTITION BY feature) AS ct FROM {n['hb']}",
        n["ps"]: f"""SELECT feature, max(n_edges) AS n_edges, max(ct) AS ct,
                   sum(CASE WHEN ct > 0 THEN (greatest(cn / ct, {D.PSI_EPS}) - greatest(rn / rt, {D.PSI_EPS}))
                       * ln(greatest(cn / ct, {D.PSI_EPS}) / greatest(rn / rt, {D.PSI_EPS})) END) AS psi
                  FROM {n['ht']} GROUP BY feature""",
        n["kv"]: f"""SELECT feature, value, sum(rc) AS rc, sum(cc) AS cc FROM (
                   SELECT feature, value, 1 AS rc, 0 AS cc FROM {n['rl']} UNION ALL
                   SELECT feature, value, 0, 1 FROM {n['cl']}) GROUP BY feature, value""",
        n["kc"]: f"""SELECT kv.feature, sum(rc) OVER w AS cr, sum(cc) OVER w AS cc2, nr.n_ref, nc.n_cur
                 FROM {n['kv']} kv JOIN {n['nr']} nr USING (feature) JOIN {n['nc']} nc USING (feature)
                 WINDOW w AS (PARTITION BY kv.feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        n["kd"]: f"SELECT feature, max(abs(cr / n_ref - cc2 / n_cur)) AS d, max(n_ref) AS n, max(n_cur) AS m FROM {n['kc']} GROUP BY feature",
        n["kx"]: f"""SELECT * FROM (WITH RECURSIVE s AS (
                   SELECT feature, 0 AS k, a, b, h, list_transform(range(0, a + 1), lambda i: 0.0::DOUBLE) AS r FROM (
                     SELECT feature, least(n, m) AS a, greatest(n, m) AS b, round(d * lcm(n, m)::DOUBLE) AS h FROM {n['kd']}
                     WHERE greatest(n, m) <= {D.EXACT_KS_ROWS} AND least(n, m) > 0)
                   UNION ALL
                   SELECT feature, k + 1, a, b, h, list_transform(range(0, a + 1), lambda i:
                     CASE WHEN i > k + 1 OR k + 1 - i > b THEN 0.0
                          WHEN abs(i * (lcm(a, b) // a) - (k + 1 - i) * (lcm(a, b) // b)) >= h THEN 1.0
                          ELSE (i * CASE WHEN i > 0 THEN r[i] ELSE 0 END + (k + 1 - i) * r[i + 1]) / (k + 1)::DOUBLE END)
                   FROM s WHERE k < a + b)
                 SELECT feature, CASE WHEN h <= 0 THEN 1.0 ELSE r[a + 1] END AS p FROM s WHERE k = a + b)""",
        n["ks"]: f"""SELECT kd.feature, d, least(greatest(coalesce(kx.p, CASE WHEN d * sqrt(n * m / (n + m)) < 0.2 THEN 1.0 ELSE
                   2 * list_sum(list_transform(range(1, {D.KS_SERIES_TERMS + 1}),
                     lambda k: pow(-1.0, k - 1) * exp(-2.0 * k * k * (d * sqrt(n * m / (n + m))) * (d * sqrt(n * m / (n + m))))))
                   END), 0.0), 1.0) AS p FROM {n['kd']} kd LEFT JOIN {n['kx']} kx ON kd.feature = kx.feature""",
        n["core"]: f"""SELECT nr.feature, nr.n_ref, nc.n_cur,
                     CASE WHEN nr.n_ref = 0 OR nc.n_cur = 0 THEN 0.0
                          WHEN coalesce(ps.n_edges, 0) < 2 THEN 0.0
                          WHEN ps.ct = 0 THEN NULL ELSE ps.psi END AS psi,
                     coalesce(ks.d, 0.0) AS ks_statistic, coalesce(ks.p, 1.0) AS ks_p_value
                   FROM {n['nr']} nr JOIN {n['nc']} nc USING (feature) LEFT JOIN {n['ps']} ps USING (feature)
                   LEFT JOIN {n['ks']} ks USING (feature)""",
    }


def _frames(spark, d):
    ref, cur = B.drift_frames(spark, d)
    return ref, cur


@query("quantile_edges", with_views("""
SELECT feature, CAST(i AS INTEGER) AS edge_index, round(edges[i + 1], 6) AS edge
FROM (SELECT feature, edges, unnest(range(0, len(edges))) AS i FROM e)
""", "v_ref", extra=_drift_ctes("v_ref", "v_cur", FEATS)))
def q_quantile_edges(spark, d):
    ref, _ = _frames(spark, d)
    e = D.quantile_edges(ref, FEATS)
    return e.select("feature", F.posexplode("edges").alias("edge_index", "edge")).select(
        "feature", F.col("edge_index").cast("int"), F.round("edge", 6).alias("edge"))


@query("histogram", with_views("""
SELECT 'ref' AS side, feature, CAST(bin AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n FROM rb GROUP BY feature, bin
UNION ALL
SELECT 'cur', feature, CAST(bin AS INTEGER), CAST(count(*) AS BIGINT) FROM cb GROUP BY feature, bin
""", "v_ref", "v_cur", extra=_drift_ctes("v_ref", "v_cur", FEATS)))
def q_histogram(spark, d):
    ref, cur = _frames(spark, d)
    h = D.histogram(D.two_sides(ref, cur, FEATS), D.quantile_edges(ref, FEATS))
    sides = F.inline(F.array(F.struct(F.lit("ref").alias("side"), F.col("rn").alias("n")),
                             F.struct(F.lit("cur").alias("side"), F.col("cn").alias("n"))))
    return h.select("feature", F.col("bin").cast("int"), sides).where("n > 0")


@query("psi", with_views(
    "SELECT feature, round(psi, 6) AS psi FROM core", "v_ref", "v_cur",
    extra=_drift_ctes("v_ref", "v_cur", FEATS)))
def q_psi(spark, d):
    ref, cur = _frames(spark, d)
    return D.psi_table(ref, cur, FEATS).select("feature", F.round("psi", 6).alias("psi"))


@query("ks_2samp", with_views(
    "SELECT feature, round(ks_statistic, 6) AS ks_statistic, round(ks_p_value, 6) AS ks_p_value FROM core",
    "v_ref", "v_cur", extra=_drift_ctes("v_ref", "v_cur", FEATS)))
def q_ks_2samp(spark, d):
    ref, cur = _frames(spark, d)
    t = D.ks_table(ref, cur, FEATS)
    return t.select("feature", F.round("ks_statistic", 6).alias("ks_statistic"),
                    F.round("ks_p_value", 6).alias("ks_p_value"))


_SEV = f"""CASE WHEN coalesce(psi, 0) >= {D.PSI_ALERT} OR ks_p_value < {D.KS_ALPHA} THEN 'alert'
               WHEN coalesce(psi, 0) >= {D.PSI_WARN} THEN 'warning' ELSE 'ok' END"""


@query("feature_drift", with_views(f"""
SELECT feature, round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic,
       round(ks_p_value, 6) AS ks_p_value, {_SEV} AS severity, ({_SEV}) = 'alert' AS alert,
       CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur
FROM core""", "v_ref", "v_cur", extra=_drift_ctes("v_ref", "v_cur", FEATS)))
def q_feature_drift(spark, d):
    ref, cur = _frames(spark, d)
    return D.feature_drift(ref, cur, FEATS + ["not_a_column"])


_SREF = "SELECT pd FROM v_score WHERE period < '1998-07'"
_SCUR = "SELECT pd FROM v_score WHERE period >= '1998-07'"


def _score_frames(spark, d):
    s = B.scores(spark, d)
    return s.where(F.col("period") < "1998-07"), s.where(F.col("period") >= "1998-07")


_PCT = ", ".join(f"round(quantile_cont(pd, {p / 100}), 6) AS p{p}" for p in D.REPORT_PERCENTILES)


@query("percentiles", with_views(f"""
SELECT 'ref' AS side, {_PCT} FROM sref UNION ALL SELECT 'cur', {_PCT} FROM scur
""", "v_score", extra={"sref": _SREF, "scur": _SCUR}))
def q_percentiles(spark, d):
    r, c = _score_frames(spark, d)
    return D.percentiles(r, "pd").select(F.lit("ref").alias("side"), "*").unionByName(
        D.percentiles(c, "pd").select(F.lit("cur").alias("side"), "*"))


_SSEV = f"""CASE WHEN coalesce(psi, 0) >= {D.PSI_ALERT} OR (ks_p_value < {D.KS_ALPHA} AND ks_statistic >= {D.KS_STAT_ALERT})
               THEN 'alert' WHEN coalesce(psi, 0) >= {D.PSI_WARN} THEN 'warning' ELSE 'ok' END"""
_RPCT = ", ".join(f"round(quantile_cont(pd, {p / 100}), 6) AS ref_p{p}" for p in D.REPORT_PERCENTILES)
_CPCT = ", ".join(f"round(quantile_cont(pd, {p / 100}), 6) AS cur_p{p}" for p in D.REPORT_PERCENTILES)


@query("score_drift", with_views(f"""
SELECT round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic, round(ks_p_value, 6) AS ks_p_value,
       {', '.join(f'ref_p{p}' for p in D.REPORT_PERCENTILES)}, {', '.join(f'cur_p{p}' for p in D.REPORT_PERCENTILES)},
       round(cm - rm, 6) AS mean_shift, {_SSEV} AS severity, ({_SSEV}) = 'alert' AS alert
FROM core, (SELECT {_RPCT}, avg(pd) AS rm FROM sref) a, (SELECT {_CPCT}, avg(pd) AS cm FROM scur) b
""", "v_score", extra={"sref": _SREF, "scur": _SCUR, **_drift_ctes("sref", "scur", ["pd"])}))
def q_score_drift(spark, d):
    r, c = _score_frames(spark, d)
    return D.score_drift(r, c, "pd")


@query("drift_severity", with_views(f"""
SELECT feature, {_SEV} AS feature_severity,
       CASE WHEN coalesce(psi, 0) >= {D.PSI_ALERT} OR (ks_p_value < {D.KS_ALPHA} AND ks_statistic >= {D.KS_STAT_ALERT})
            THEN 'alert' WHEN coalesce(psi, 0) >= {D.PSI_WARN} THEN 'warning' ELSE 'ok' END AS score_rule_severity
FROM core""", "v_ref", "v_cur", extra=_drift_ctes("v_ref", "v_cur", FEATS)))
def q_drift_severity(spark, d):
    """P-15: the feature rule and the score rule (with the KS distance guard) side by side."""
    ref, cur = _frames(spark, d)
    core = D.drift_core(ref, cur, FEATS)
    return core.select("feature", D.feature_severity(F.col("psi"), F.col("ks_p_value")).alias("feature_severity"),
                       D.score_severity(F.col("psi"), F.col("ks_p_value"), F.col("ks_statistic"))
                       .alias("score_rule_severity"))


_RANKS = ", ".join(f"({p})" for p in D.REPORT_PERCENTILES)


@query("sketch_percentiles", with_views(f"""
SELECT feature, pct, count(*) AS n, true AS within_bound FROM rl CROSS JOIN (VALUES {_RANKS}) t(pct) GROUP BY feature, pct
""", "v_ref", extra={"rl": _long("v_ref", FEATS)}))
def q_sketch_percentiles(spark, d):
    """A-12 by sketches kept per batch of orders and merged: whether the values found lie, in the exact ranks of
    the whole table, within the stated bound of their percentile."""
    ref, _ = _frames(spark, d)
    got = S.sketch_percentiles(S.sketch_profile(ref, FEATS, F.expr("pmod(l_orderkey, 24)")))
    values = F.array(*[F.struct(F.lit(p).alias("pct"), F.col(f"p{p}").alias("found")) for p in D.REPORT_PERCENTILES])
    found = got.select("feature", F.inline(values))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in FEATS])
    rows = ref.select(F.inline(pairs)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    ranks = rows.join(F.broadcast(found), "feature").groupBy("feature", "pct").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("value") < F.col("found")).cast("int")).alias("low"),
        F.avg((F.col("value") <= F.col("found")).cast("int")).alias("high"))
    # Merging sketches adds to what one pass is off by.
    slack = 2 * S.rank_error()
    return ranks.select("feature", "pct", "n", F.coalesce((F.col("low") - slack <= F.col("pct") / 100) & (
        F.col("pct") / 100 <= F.col("high") + slack), F.lit(False)).alias("within_bound"))


@query("sketch_psi")
def q_sketch_psi(spark, d):
    """M-3 by sketches (rows only, tested against the exact PSI): both sides from profiles of batches."""
    return S.sketch_psi(*[S.sketch_profile(f, FEATS, F.expr("pmod(l_orderkey, 24)")) for f in _frames(spark, d)])
