"""Queries: PD models, calibration, scoring and attribution (L-1..L-4, L-8, L-14..L-18,
N-5, N-6) on the feature table with the P-11 default label."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import models as ML
from ..operators import split as SP
from ..operators.attribution import mean_abs_tree_attribution
from ..operators.labels import default_label
from .catalog import query
from .oracle_views import with_views
from .q_features import _ORIG_FEATURES_SQL, _SUMMARY_SQL, q_feature_table

FEATS = ML.PD_FEATURES
# Fixed illustrative model for the SQL-checkable attribution: (coefficient, fill, mean, std) per
# feature, as ``fitted_terms`` reads them from a fitted pipeline.
TERMS = {f: ML.LinearTerm(*v) for f, v in {
    "credit_score": (-0.8, 700.0, 690.0, 60.0), "orig_ltv": (0.5, 75.0, 74.0, 15.0),
    "orig_cltv": (0.45, 76.0, 75.0, 15.0), "orig_dti": (0.3, 35.0, 34.0, 10.0),
    "orig_upb": (0.1, 200000.0, 210000.0, 110000.0), "orig_interest_rate": (0.6, 5.0, 5.2, 1.5),
    "orig_loan_term": (0.05, 360.0, 320.0, 70.0), "num_units": (0.02, 1.0, 1.1, 0.4),
    "num_borrowers": (-0.25, 2.0, 1.6, 0.5), "log_upb": (0.2, 12.0, 12.1, 0.6),
    "is_first_time_homebuyer": (0.04, 0.0, 0.4, 0.5), "is_high_ltv": (0.15, 0.0, 0.3, 0.45),
    "is_high_dti": (0.1, 0.0, 0.2, 0.4), "is_arm": (0.05, 0.0, 0.1, 0.3), "is_jumbo": (0.03, 0.0, 0.05, 0.2),
    "occupancy_code": (0.07, 0.0, 0.5, 0.8), "loan_purpose_code": (0.06, 1.0, 1.2, 1.0),
    "channel_code": (0.08, 0.0, 0.7, 0.9), "property_type_code": (0.09, 0.0, 0.8, 1.1)}.items()}
COEFS = {f: t.coef for f, t in TERMS.items()}
ATTR_FEATS = list(TERMS)


def training_frame(spark, d):
    from ..functions.clean import clip
    from ..functions.features import CLIP_BOUNDS
    from . import bindings as B

    ft = q_feature_table(spark, d)
    cltv = B.orig(spark, d).select("loan_id", clip(F.col("orig_cltv"), *CLIP_BOUNDS["orig_cltv"]).alias("orig_cltv"))
    ft = ft.join(cltv, "loan_id", "left")
    tf = ft.withColumn("label", default_label(ft)).withColumnRenamed("loan_id", "id")
    # Iterative fitting re-reads its input many times: cut the lineage once, in the
    # shared checkpoint folder (reliable, survives a lost executor).
    return tf.checkpoint(eager=True)


def split_frame(spark, d):
    """The training frame with its ``split``, found once: every pass of a fit reads the stored rows."""
    return SP.stratified_split(training_frame(spark, d), "label", "id", 0.2).checkpoint(eager=True)


def _split(spark, d):
    sp = split_frame(spark, d)
    return sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")


@query("pd_logreg")
def q_pd_logreg(spark, d):
    """L-1 (rows only): test-split scores of the balanced L2 logistic pipeline."""
    train, test = _split(spark, d)
    m = ML.fit_logreg(train, FEATS)
    return ML.predict_pd(m, test, FEATS).select("id", "label", "pd")


@query("pd_random_forest")
def q_pd_random_forest(spark, d):
    """L-2 (rows only): test-split scores of the 200-tree balanced forest."""
    train, test = _split(spark, d)
    m = ML.fit_random_forest(train, FEATS)
    return ML.predict_pd(m, test, FEATS).select("id", "label", "pd")


@query("pd_boosted_trees")
def q_pd_boosted_trees(spark, d):
    """L-3 (rows only): boosted trees picked by seeded random search with 3-fold CV AUC,
    then validation AUC, AP, Brier, log loss, accuracy and the CV AUC. The search is the
    reference's: 25 draws of 100 to 600 rounds (75 fits)."""
    train, test = _split(spark, d)
    model, cv_auc, _ = ML.fit_boosted_trees(train, FEATS, id_col="id")
    scored = ML.predict_pd(model, test, FEATS).select("id", "label", "pd")
    bm = M.binary_metrics(scored).select("auc_roc", "average_precision", "brier_score")
    ll = M.log_loss_accuracy(scored).select("log_loss", "accuracy")
    from ..operators.ranking import attach

    return attach(bm, ll).withColumn("cv_roc_auc", F.lit(round(cv_auc, 6)))


@query("tree_attribution")
def q_tree_attribution(spark, d):
    """L-17 for trees (rows only): mean absolute Shapley value per feature of a boosted model, over all
    test rows."""
    train, test = _split(spark, d)
    model = ML.fit_trees(train, FEATS, ML.Params(rounds=100, depth=4), id_col="id")
    return mean_abs_tree_attribution(model, test)


@query("baseline_logreg")
def q_baseline_logreg(spark, d):
    """L-4 + L-18 (rows only): time split 60/20/20 on the first-payment month, scaled logistic
    (C = 1), L-5 metrics per split with the split boundaries."""
    from . import bindings as B

    tf = training_frame(spark, d)
    months = B.orig(spark, d).select(F.col("loan_id").alias("id"), "first_payment_month")
    tf = tf.join(months, "id")
    sp = SP.time_split(tf, "first_payment_month").checkpoint(eager=True)
    cuts = SP.split_cuts(sp, "first_payment_month")
    m = ML.fit_logreg(sp.where(F.col("split") == "train"), FEATS, c=1.0, max_iter=1000, balanced=False)
    scored = ML.predict_pd(m, sp, FEATS).select("split", "label", "pd")
    mets = M.binary_metrics(scored, ["split"])
    from ..operators.ranking import attach

    return attach(mets, cuts.select("train_end", "val_end", "test_end"))


@query("calibrate")
def q_calibrate(spark, d):
    """L-8 + L-9 (rows only): isotonic and sigmoid maps fitted on validation scores; ECE of the
    raw and calibrated probabilities on the test split."""
    train, test = _split(spark, d)
    # Deterministic halves: fit on one, calibrate on the other.
    tr = train.where(F.xxhash64("id") % 2 == 0)
    va = train.where(F.xxhash64("id") % 2 != 0)
    m = ML.fit_logreg(tr, FEATS)
    base = ML.predict_pd(m, test, FEATS).select("id", "label", "pd")
    out = [M.ece(base).select(F.lit("raw").alias("method"), "ece", "n")]
    for meth in ("isotonic", "sigmoid"):
        cal = ML.calibrate(m, va, FEATS, method=meth)
        c = cal(base).select("label", F.col("pd_cal").alias("pd"))
        out.append(M.ece(c).select(F.lit(meth).alias("method"), "ece", "n"))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("batch_score")
def q_batch_score(spark, d):
    """L-14 (rows only): probability, decision and top-5 factors for every loan in one pass."""
    sp = split_frame(spark, d)
    m = ML.fit_logreg(sp.where(F.col("split") == "train"), FEATS)
    s = ML.batch_score(m, sp, FEATS, ML.fitted_terms(m, FEATS))
    return s.select("id", "pd", "decision", F.to_json("factors").alias("factors"))


def _attr_frame(spark, d):
    """The feature table with orig_cltv: every model feature."""
    from ..functions.clean import clip
    from ..functions.features import CLIP_BOUNDS
    from . import bindings as B

    cltv = B.orig(spark, d).select("loan_id", clip(F.col("orig_cltv"), *CLIP_BOUNDS["orig_cltv"]).alias("orig_cltv"))
    return q_feature_table(spark, d).join(cltv, "loan_id", "left")


def _attr_sql() -> dict[str, str]:
    unions = " UNION ALL ".join(
        f"SELECT loan_id AS id, '{f}' AS name, (coalesce(CAST({f} AS DOUBLE), {t.fill}::DOUBLE) - {t.mean}::DOUBLE) "
        f"/ {t.std}::DOUBLE * {t.coef}::DOUBLE AS value FROM ft" for f, t in TERMS.items())
    return {
        "ft": f"""SELECT f.*, s.max_loan_age, s.latest_upb, s.max_dpd,
                  greatest(0.0, least(105.0, CAST(o.orig_cltv AS DOUBLE))) AS orig_cltv FROM ({_ORIG_FEATURES_SQL}) f
                  JOIN v_orig o ON f.loan_id = o.loan_id
                  LEFT JOIN ({_SUMMARY_SQL}) s ON o.loan_sequence_number = s.loan_sequence_number""",
        "contrib": unions,
    }


@query("linear_contributions", with_views("""
SELECT id, CAST(rank AS INTEGER) AS rank, name, round(value, 6) AS value FROM (
  SELECT id, name, value, row_number() OVER (PARTITION BY id ORDER BY abs(value) DESC, name) AS rank
  FROM contrib) WHERE rank <= 5""", "v_orig", "v_perf", extra=_attr_sql()))
def q_linear_contributions(spark, d):
    """L-15 + N-5: standardised value × coefficient, top 5 by absolute value per loan."""
    tf = _attr_frame(spark, d).withColumnRenamed("loan_id", "id")
    lc = ML.linear_contributions(tf, TERMS)
    return lc.select("id", F.col("rank").cast("int"), "name", F.round("value", 6).alias("value"))


def _mean_abs_sql() -> dict[str, str]:
    stats = ", ".join(f"avg(CAST({f} AS DOUBLE)) AS m_{f}" for f in ATTR_FEATS)
    unions = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, avg(abs({COEFS[f]} * (CAST(t.{f} AS DOUBLE) - s.m_{f}))) AS importance "
        f"FROM ft t, sm s" for f in ATTR_FEATS)
    return {**_attr_sql(), "sm": f"SELECT {stats} FROM ft", "imp": unions}


@query("mean_abs_attribution", with_views(
    "SELECT feature, round(importance, 6) AS importance FROM imp", "v_orig", "v_perf", extra=_mean_abs_sql()))
def q_mean_abs_attribution(spark, d):
    """L-17 (linear, exact): mean |β·(x − mean)| per feature."""
    tf = _attr_frame(spark, d)
    a = ML.mean_abs_attribution(tf, ATTR_FEATS, COEFS)
    return a.select("feature", F.round("importance", 6).alias("importance"))


@query("topn_importance", with_views(
    "SELECT feature, round(importance, 6) AS importance FROM imp ORDER BY importance DESC, feature LIMIT 3",
    "v_orig", "v_perf", extra=_mean_abs_sql()))
def q_topn_importance(spark, d):
    """N-6: the top features by mean absolute contribution (display limit 3 here)."""
    tf = _attr_frame(spark, d)
    a = ML.mean_abs_attribution(tf, ATTR_FEATS, COEFS, max_display=3)
    return a.select("feature", F.round("importance", 6).alias("importance"))


@query("global_importance")
def q_global_importance(spark, d):
    """L-16 (rows only): forest importances, descending."""
    train, _ = _split(spark, d)
    return ML.global_importance(ML.fit_random_forest(train, FEATS), FEATS)


@query("permutation_importance")
def q_permutation_importance(spark, d):
    """L-17 for a fitted model (rows only): AUC drop per shuffled feature."""
    train, test = _split(spark, d)
    m = ML.fit_logreg(train, FEATS)
    return ML.permutation_importance(m, test, FEATS)


@query("training_metrics_report")
def q_training_metrics_report(spark, d):
    """L-18 (rows only): L-5 on train and test splits of the logistic model, one row each."""
    train, test = _split(spark, d)
    m = ML.fit_logreg(train, FEATS)
    tr = ML.predict_pd(m, train, FEATS).select(F.lit("train").alias("split"), "label", "pd")
    te = ML.predict_pd(m, test, FEATS).select(F.lit("test").alias("split"), "label", "pd")
    return M.binary_metrics(tr.unionByName(te), ["split"])


@query("topn_factors", with_views("""
SELECT id, CAST(rank AS INTEGER) AS rank, name, round(value, 6) AS value FROM (
  SELECT id, name, value, row_number() OVER (PARTITION BY id ORDER BY abs(value) DESC, name) AS rank
  FROM contrib) WHERE rank <= 3""", "v_orig", "v_perf", extra=_attr_sql()))
def q_topn_factors(spark, d):
    """N-5: the top 3 factors per loan by absolute contribution (array sort, no row shuffle)."""
    tf = _attr_frame(spark, d).withColumnRenamed("loan_id", "id")
    lc = ML.linear_contributions(tf, TERMS, top_n=3)
    return lc.select("id", F.col("rank").cast("int"), "name", F.round("value", 6).alias("value"))
