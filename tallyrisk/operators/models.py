"""Default-probability models, calibration, scoring and attribution with ``pyspark.ml``
(L-1..L-4, L-8, L-14..L-18, N-5, N-6).

Training, scoring and attribution are distributed ML pipelines; probabilities
leave the vector type through ``vector_to_array`` and every per-row step
(decision, factor ranking) is a column expression — no Python UDF.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .boosting import BROADCAST_BYTES, BoostedModel, Params, fit_many, quantile_edges
from .forest import ForestModel, fit_forest
from .isotonic import isotonic_blocks, isotonic_map
from .ranking import attach

# ---------------------------------------------------------------------------
# The reference's PD feature list and model settings.
# ---------------------------------------------------------------------------
PD_FEATURES = [
    "credit_score", "orig_ltv", "orig_cltv", "orig_dti", "orig_upb", "orig_interest_rate",
    "orig_loan_term", "num_units", "num_borrowers", "log_upb", "is_first_time_homebuyer",
    "is_high_ltv", "is_high_dti", "is_arm", "is_jumbo", "occupancy_code", "loan_purpose_code",
    "channel_code", "property_type_code",
]
LOGREG_C = 0.1
LOGREG_MAX_ITER = 500
RF_TREES, RF_DEPTH, RF_MIN_LEAF = 200, 8, 50
MEDIAN_ERROR = 1e-3
SEED = 42
# The reference's search ranges for boosted trees (both ends included).
SEARCH = {"rounds": (100, 600), "depth": (3, 9), "step": (0.01, 0.30), "rows": (0.6, 1.0),
          "columns": (0.5, 1.0), "leaf": (1, 10), "l1": (0.0, 1.0), "l2": (0.5, 5.0)}
TOP_FACTORS = 5
MAX_DISPLAY = 20


def with_balanced_weight(df: DataFrame, label_col: str = "label", weight_col: str = "w") -> DataFrame:
    """Balanced class weights n / (2 · n_class) as a column (A-8)."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    wt = attach(counts, tot).select(label_col, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(weight_col))
    return df.join(F.broadcast(wt), label_col, "left")


def _prep(features: list[str], out: str = "features", scale: bool = True):
    imp_cols = [f"{c}__imp" for c in features]
    # Medians come from quantile sketches: rank error MEDIAN_ERROR, memory independent of the rows.
    stages = [Imputer(inputCols=features, outputCols=imp_cols, strategy="median", relativeError=MEDIAN_ERROR)]
    stages.append(VectorAssembler(inputCols=imp_cols, outputCol="raw_features" if scale else out,
                                  handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol=out, withMean=True, withStd=True))
    return stages


def _cast_features(df: DataFrame, features: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in features else F.col(c) for c in df.columns])


def fit_logreg(train: DataFrame, features: list[str], label_col: str = "label", c: float = LOGREG_C,
               max_iter: int = LOGREG_MAX_ITER, balanced: bool = True) -> PipelineModel:
    """L-1: median impute → standardise → L2 logistic.

    The reference minimises C·Σ wᵢ·lossᵢ + ½‖β‖²; Spark minimises Σ wᵢ·lossᵢ / Σ wᵢ + regParam·½‖β‖²,
    so regParam = 1 / (C · Σ wᵢ) gives the same optimum (T6).
    """
    df = _cast_features(train, features)
    if balanced:
        df = with_balanced_weight(df, label_col)
    else:
        df = df.withColumn("w", F.lit(1.0))
    sum_w = df.agg(F.sum("w")).first()[0] or 1.0
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, weightCol="w",
                            regParam=1.0 / (c * sum_w), elasticNetParam=0.0, maxIter=max_iter,
                            standardization=False, tol=1e-6)
    return Pipeline(stages=_prep(features) + [lr]).fit(df)


def fit_random_forest(train: DataFrame, features: list[str], label_col: str = "label",
                      n_trees: int = RF_TREES, depth: int = RF_DEPTH, min_leaf: int = RF_MIN_LEAF,
                      seed: int = SEED) -> ForestModel:
    """L-2: median impute → random forest with balanced class weights (A-8), grown by ``forest``."""
    df = _cast_features(train, features)
    counts = {r[0]: r[1] for r in df.groupBy(label_col).count().collect()}    # two classes
    if not counts or set(counts) - {0, 1}:
        raise ValueError(f"the forest needs labels of 0 and 1; found {sorted(map(str, counts))}")
    weights = np.array([sum(counts.values()) / (len(counts) * counts[c]) if c in counts else 0.0 for c in (0, 1)])
    return fit_forest(df, features, label_col, weights, n_trees, depth, min_leaf, seed)


def search_draws(n: int, seed: int = SEED, search: dict[str, tuple] | None = None) -> list[Params]:
    """``n`` seeded draws from the ranges of ``SEARCH``, some of which ``search`` may narrow."""
    rng, span = random.Random(seed), SEARCH | (search or {})
    whole = ("rounds", "depth", "leaf")
    return [Params(**{k: rng.randint(*r) if k in whole else rng.uniform(*r) for k, r in span.items()}) for _ in range(n)]


def fit_boosted_trees(train: DataFrame, features: list[str], label_col: str = "label", n_iter: int = 25,
                      folds: int = 3, seed: int = SEED, search: dict[str, tuple] | None = None,
                      id_col: str | None = None, broadcast_bytes: int = BROADCAST_BYTES
                      ) -> tuple[BoostedModel, float, Params]:
    """L-3: boosted trees picked by a seeded random search scored by the mean AUC over ``folds`` folds.

    All draws and folds grow side by side (``boosting``), with class weights that balance the classes.
    Returns ``(model on all rows, best CV AUC, its parameters)``.
    """
    draws = search_draws(n_iter, seed, search)
    plans = [(p, fold) for p in draws for fold in range(folds)]
    edges = quantile_edges(train, features)
    _, scores, _ = fit_many(train, features, label_col, plans, folds, seed, id_col, edges, broadcast_bytes)

    def mean(i: int) -> float:      # a fold of one class has no AUC
        own = [s for k in range(folds) if (s := scores.get(i * folds + k)) is not None and s == s]
        return sum(own) / len(own) if own else float("-inf")
    best = max(range(n_iter), key=mean)
    return fit_trees(train, features, draws[best], label_col, seed, id_col, edges, broadcast_bytes), mean(best), draws[best]


def fit_trees(train: DataFrame, features: list[str], params: Params, label_col: str = "label", seed: int = SEED,
              id_col: str | None = None, edges: list | None = None,
              broadcast_bytes: int = BROADCAST_BYTES) -> BoostedModel:
    """One boosted model on all rows."""
    fits, _, edges = fit_many(train, features, label_col, [(params, -1)], 1, seed, id_col, edges, broadcast_bytes)
    return BoostedModel(list(features), edges, fits[0].trees)


def predict_pd(model: PipelineModel | BoostedModel | ForestModel, df: DataFrame, features: list[str], out: str = "pd") -> DataFrame:
    """Probability of the positive class as a double column."""
    if isinstance(model, (BoostedModel, ForestModel)):
        return model.transform(df, out)
    scored = model.transform(_cast_features(df, features))
    return scored.withColumn(out, vector_to_array(F.col("probability")).getItem(1))


def calibrate(model: PipelineModel, val: DataFrame, features: list[str], label_col: str = "label",
              method: str = "isotonic"):
    """L-8: a mapping from the base score to a calibrated probability, fitted on ``val``.

    ``isotonic`` — weighted isotonic regression on the score; ``isotonic_ranges`` — the same fit
    pooled by ranges, whose blocks never meet on the driver; ``sigmoid`` — Platt
    scaling, a one-feature logistic regression on the log-odds. Returns a function
    ``DataFrame(with pd) → DataFrame(with pd_cal)``; the base model is untouched.
    """
    scored = predict_pd(model, val, features)
    if method == "isotonic":
        # One weighted row per distinct score carries all that the fit needs.
        rows = scored.groupBy("pd").agg(F.avg(F.col(label_col).cast("double")).alias(label_col),
                                        F.count(F.lit(1)).cast("double").alias("w"))
        iso = IsotonicRegression(featuresCol="pd", labelCol=label_col, weightCol="w", predictionCol="pd_cal").fit(rows)

        def apply(df: DataFrame) -> DataFrame:
            return iso.transform(df)
        return apply
    if method == "isotonic_ranges":
        fitted = isotonic_map(isotonic_blocks(scored, "pd", label_col))

        def apply(df: DataFrame) -> DataFrame:
            return fitted(df, "pd", "pd_cal")
        return apply
    if method == "sigmoid":
        eps = 1e-12
        logit = F.log(F.greatest(F.col("pd"), F.lit(eps)) / F.greatest(1 - F.col("pd"), F.lit(eps)))
        va = VectorAssembler(inputCols=["_logit"], outputCol="_lf")
        train = va.transform(scored.select(logit.alias("_logit"), F.col(label_col)))
        lr = LogisticRegression(featuresCol="_lf", labelCol=label_col, regParam=0.0).fit(train)
        a, b = float(lr.coefficients[0]), float(lr.intercept)

        def apply(df: DataFrame) -> DataFrame:
            return df.withColumn("pd_cal", 1 / (1 + F.exp(-(F.lit(a) * logit + F.lit(b)))))
        return apply
    raise ValueError(f"unknown calibration method {method!r}")


@dataclass(frozen=True)
class LinearTerm:
    """What a fitted linear model does with one feature: fill a null, standardise, weight."""
    coef: float
    fill: float
    mean: float
    std: float


def fitted_terms(model: PipelineModel, features: list[str]) -> dict[str, LinearTerm]:
    """The terms of a ``fit_logreg`` pipeline, from its own imputer, scaler and coefficients."""
    imputer, scaler, lr = model.stages[0], model.stages[2], model.stages[-1]
    fills = imputer.surrogateDF.first().asDict()
    return {f: LinearTerm(float(c), float(fills[f]), float(m), float(s)) for f, c, m, s in zip(
        features, lr.coefficients.toArray(), scaler.mean.toArray(), scaler.std.toArray())}


def contributions_column(terms: dict[str, LinearTerm], top_n: int = TOP_FACTORS) -> Column:
    """L-15 + N-5: standardised value x coefficient per feature, the ``top_n`` largest by absolute
    value (ties by name) as ``array<struct<name, value>>``; depends on the row and the model only."""
    items = []
    for f, t in terms.items():
        x = F.coalesce(F.col(f).cast("double"), F.lit(t.fill))
        z = (x - t.mean) / t.std if t.std else F.lit(0.0)
        items.append(F.struct(F.lit(f).alias("name"), (z * t.coef).alias("value")))
    arr = F.array(*items)
    ordered = F.array_sort(arr, lambda a, b: F.when(F.abs(a["value"]) > F.abs(b["value"]), -1)
                           .when(F.abs(a["value"]) < F.abs(b["value"]), 1)
                           .when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0))
    return F.slice(ordered, 1, top_n)


def linear_contributions(df: DataFrame, terms: dict[str, LinearTerm], id_col: str = "id",
                         top_n: int = TOP_FACTORS) -> DataFrame:
    """L-15: per row the top factors under the model's own preprocessing."""
    col = contributions_column(terms, top_n)
    return df.select(F.col(id_col), F.posexplode(col).alias("rank", "factor")).select(
        id_col, (F.col("rank") + 1).alias("rank"), F.col("factor.name").alias("name"),
        F.col("factor.value").alias("value"))


def mean_abs_attribution(df: DataFrame, features: list[str], coefs: dict[str, float],
                         max_display: int = MAX_DISPLAY) -> DataFrame:
    """L-17 (linear, exact) + N-6: mean |β·(x − mean)| per feature, top ``max_display``."""
    stats = df.agg(*[F.avg(F.col(f).cast("double")).alias(f"m_{f}") for f in features])
    j = attach(df.select(*features), stats)
    attr = j.select(*[F.abs(F.lit(coefs[f]) * (F.col(f).cast("double") - F.col(f"m_{f}"))).alias(f)
                      for f in features])
    means = attr.agg(*[F.avg(f).alias(f) for f in features])
    long = means.unpivot([], features, "feature", "importance")
    return long.orderBy(F.col("importance").desc(), F.col("feature")).limit(max_display)


def permutation_importance(model: PipelineModel, df: DataFrame, features: list[str],
                           id_col: str = "id", label_col: str = "label", seed: int = SEED,
                           bucket_rows: int = 1000, model_features: list[str] | None = None) -> DataFrame:
    """L-17 for trees: AUC drop when one feature's values are shuffled, all features in one job.

    The shuffle is a rotation inside hash buckets of about ``bucket_rows`` rows ordered by a
    second seeded hash of the id: deterministic (safe to recompute after a lost executor),
    no global sort, and it breaks the feature-label association. Each row is scored once as it
    is and once per feature. A one-class test set gives NULL importances. A different statistic
    than tree SHAP values (documented). ``features``: those to shuffle, of ``model_features``.
    """
    from pyspark.sql import Window

    from .metrics import auc

    spark = df.sparkSession
    inputs = model_features or features
    n = df.count()
    nb = max(1, n // bucket_rows)
    keyed = df.withColumn("_b", F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(nb))) \
              .withColumn("_o", F.xxhash64(F.col(id_col), F.lit(seed + 1)))
    w = Window.partitionBy("_b").orderBy("_o", id_col)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rotated = keyed.select(label_col, *inputs, *[
        F.coalesce(F.lag(F.col(f), 1).over(w), F.last(F.col(f)).over(whole)).alias(f"_r_{f}") for f in features])

    def variant(name: str) -> Column:
        return F.struct(F.lit(name).alias("feature"), *[
            F.col(f"_r_{f}" if f == name else f).cast("double").alias(f) for f in inputs])
    rows = rotated.select(label_col, F.inline(F.array(*[variant(x) for x in ["", *features]])))
    # The curves read the scores several times: every row is scored once, and what the AUC needs of it is stored.
    path = scratch_path(spark, "permuted-scores")
    predict_pd(model, rows, inputs).select("feature", "pd", label_col).write.parquet(path)
    per = auc(spark.read.parquet(path), ["feature"], "pd", label_col,
              max_groups=len(features) + 1).checkpoint(eager=True)       # a row per feature
    base = per.where("feature = ''").select(F.col("auc").alias("_base"))
    return attach(per.where("feature <> ''"), base).select(
        "feature", (F.col("_base") - F.col("auc")).alias("importance"))


def global_importance(model: ForestModel, features: list[str]) -> DataFrame:
    """L-16: tree-model importances, descending (the same fallback factors for every row).

    The importances are model metadata (one number per feature), not data."""
    from pyspark.sql import SparkSession

    imp = model.importances
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(sorted(zip(features, imp), key=lambda t: -t[1]),
                                 "feature string, importance double")


def batch_score(model: PipelineModel | ForestModel, df: DataFrame, features: list[str],
                terms: dict[str, LinearTerm] | None = None, id_col: str = "id",
                threshold: Column | float = 0.5, top_n: int = TOP_FACTORS) -> DataFrame:
    """L-14: probability, decision (P-13, per-row threshold allowed) and top factors in one pass.

    A linear model's factors are per row (``terms``, from ``fitted_terms``); a tree model's are its
    global importances, the same for every row.
    """
    from .policy import score_decision

    scored = predict_pd(model, df, features)
    if terms is not None:
        factors = contributions_column(terms, top_n)
    else:
        imp = sorted(zip(features, model.importances),
                     key=lambda t: (-t[1], t[0]))[:top_n]
        factors = F.array(*[F.struct(F.lit(f).alias("name"), F.lit(float(v)).alias("value")) for f, v in imp])
    return scored.select(id_col, "pd", score_decision(F.col("pd"), threshold).alias("decision"),
                         factors.alias("factors"))


def logreg_coefficients(model: PipelineModel, features: list[str]) -> dict[str, float]:
    lr = model.stages[-1]
    return {f: float(c) for f, c in zip(features, lr.coefficients.toArray().tolist())}


def _trainers() -> dict:
    from .forecast import seasonal_forecast

    # The reference's model keys.
    return {"prophet": seasonal_forecast, "sklearn-logreg": fit_logreg, "sklearn-rf": fit_random_forest}


def trainer(key: str):
    """E-3: the fitting function of a model key; an unknown key is an error."""
    known = _trainers()
    if key not in known:
        raise ValueError(f"unknown model {key!r}; expected one of {sorted(known)}")
    return known[key]
