"""Classification and regression metrics as aggregations (M-7, M-10, L-5..L-10, A-8).

Everything rests on one collapsed frame: positive / negative counts per
distinct score, with distributed running sums from the top score down
(:func:`ranking.cumulative`). AUC (Mann-Whitney with ties averaged), average
precision and the best-F1 threshold are then plain aggregates over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import attach, cumulative

# float64 machine epsilon: probability clip of the log loss.
LOG_LOSS_EPS = 2.220446049250313e-16


def _counts(df: DataFrame, group_cols: list[str], score_col: str, label_col: str) -> DataFrame:
    y = F.col(label_col).cast("long")
    return df.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull()).select(
        *[F.col(g) for g in group_cols], F.col(score_col).cast("double").alias("_s"),
        y.alias("_pos"), (1 - y).alias("_neg"))


def score_curve(df: DataFrame, group_cols: list[str], score_col: str = "pd",
                label_col: str = "label", buckets: int | None = None) -> DataFrame:
    """Per distinct score (descending): pos, neg, tps = cum_pos, fps = cum_neg."""
    c = _counts(df, group_cols, score_col, label_col)
    return cumulative(c, group_cols, "_s", ["_pos", "_neg"], descending=True, buckets=buckets)


def _auc_expr() -> Column:
    # Σ pos·(neg strictly below + neg tied / 2) / (P·N); descending cum includes the tie.
    u = F.sum(F.col("_pos") * (F.col("_N") - F.col("cum__neg") + F.col("_neg") / 2.0))
    P, N = F.max("_P"), F.max("_N")
    return F.when((P > 0) & (N > 0), u / (P * N))


def _with_totals(curve: DataFrame, group_cols: list[str]) -> DataFrame:
    tot = curve.groupBy(*[F.col(g) for g in group_cols]).agg(
        F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    # One row per group. Ungrouped it is a scalar (broadcast); grouped, its size depends on
    # the caller's groups, so AQE decides at run time from the measured size.
    return curve.join(tot, group_cols, "inner") if group_cols else attach(curve, tot)


def auc(df: DataFrame, group_cols: list[str] | None = None, score_col: str = "pd",
        label_col: str = "label", buckets: int | None = None, max_groups: int | None = None) -> DataFrame:
    """M-7: ROC AUC per group; NULL when a group has one class only."""
    g = group_cols or []
    return auc_from_counts(_counts(df, g, score_col, label_col), g, buckets, max_groups)


def auc_from_counts(counts: DataFrame, group_cols: list[str],
                    buckets: int | None = None, max_groups: int | None = None) -> DataFrame:
    """AUC per group from ``(group…, _s, _pos, _neg)`` rows (counts may repeat a score)."""
    g = list(group_cols)
    curve = cumulative(counts, g, "_s", ["_pos", "_neg"], descending=True, buckets=buckets, max_groups=max_groups)
    cur = _with_totals(curve, g)
    return cur.groupBy(*[F.col(x) for x in g]).agg(
        F.max("_P").cast("bigint").alias("n_pos"), F.max("_N").cast("bigint").alias("n_neg"),
        F.round(_auc_expr(), 6).alias("auc"))


def binary_metrics(df: DataFrame, group_cols: list[str] | None = None, score_col: str = "pd",
                   label_col: str = "label", buckets: int | None = None) -> DataFrame:
    """L-5: AUC, average precision, Brier, best F1 (+precision, recall, threshold), n, rate."""
    g = group_cols or []
    cur = _with_totals(score_curve(df, g, score_col, label_col, buckets), g)
    tps, fps, P = F.col("cum__pos"), F.col("cum__neg"), F.col("_P")
    prec = F.when(tps + fps > 0, tps / (tps + fps)).otherwise(0.0)
    rec = F.when(P > 0, tps / P).otherwise(1.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    cur = cur.select("*", prec.alias("_prec"), rec.alias("_rec"), f1.alias("_f1"))
    # Ties on F1 go to the lowest threshold, as an argmax over ascending thresholds does.
    best = F.max_by(F.struct("_f1", "_prec", "_rec", "_s"),
                    F.struct(F.col("_f1"), -F.col("_s")))
    agg = cur.groupBy(*[F.col(x) for x in g]).agg(
        _auc_expr().alias("_auc"),
        F.sum(F.when(P > 0, F.col("_pos") / P * F.col("_prec"))).alias("_ap"),
        best.alias("_best"),
        F.max("_P").alias("_Pt"), F.max("_N").alias("_Nt"),
        (F.sum(F.col("_pos") * (1 - F.col("_s")) ** 2 + F.col("_neg") * F.col("_s") ** 2)
         / F.sum(F.col("_pos") + F.col("_neg"))).alias("_brier"))
    n = F.col("_Pt") + F.col("_Nt")
    return agg.select(
        *[F.col(x) for x in g],
        F.round("_auc", 6).alias("auc_roc"),
        F.round("_ap", 6).alias("average_precision"),
        F.round("_brier", 6).alias("brier_score"),
        F.round("_best._f1", 6).alias("best_f1"),
        F.round("_best._prec", 6).alias("best_precision"),
        F.round("_best._rec", 6).alias("best_recall"),
        F.round("_best._s", 6).alias("best_threshold"),
        n.cast("bigint").alias("n_samples"),
        F.round(F.col("_Pt") / n, 6).alias("positive_rate"))


def log_loss_accuracy(df: DataFrame, score_col: str = "pd", label_col: str = "label",
                      threshold: float = 0.5, group_cols: list[str] | None = None) -> DataFrame:
    """L-6: log loss with clipped probabilities and accuracy at ``threshold``."""
    g = group_cols or []
    p = F.least(F.greatest(F.col(score_col).cast("double"), F.lit(LOG_LOSS_EPS)),
                F.lit(1 - LOG_LOSS_EPS))
    y = F.col(label_col).cast("double")
    ll = -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
    acc = ((F.col(score_col) >= threshold).cast("int") == F.col(label_col)).cast("double")
    return df.groupBy(*[F.col(x) for x in g]).agg(
        F.round(F.avg(ll), 6).alias("log_loss"), F.round(F.avg(acc), 6).alias("accuracy"),
        F.count(F.lit(1)).cast("bigint").alias("n"))


def classification_report(df: DataFrame, score_col: str = "pd", label_col: str = "label",
                          threshold: float = 0.5) -> DataFrame:
    """L-7: precision / recall / F1 / support per class, accuracy, macro and weighted averages."""
    pred = (F.col(score_col) >= threshold).cast("int")
    y = F.col(label_col).cast("int")
    c = df.agg(*[F.count_if((y == a) & (pred == b)).cast("double").alias(f"c{a}{b}")
                 for a in (0, 1) for b in (0, 1)])

    def cls(k: int) -> list[Column]:
        tp = F.col(f"c{k}{k}")
        fp = F.col(f"c{1 - k}{k}")
        fn = F.col(f"c{k}{1 - k}")
        p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
        r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
        f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
        return [p, r, f, tp + fn]

    p0, r0, f0, s0 = cls(0)
    p1, r1, f1, s1 = cls(1)
    n = s0 + s1
    acc = (F.col("c00") + F.col("c11")) / n

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), F.round(p, 6).alias("precision"),
                        F.round(r, 6).alias("recall"), F.round(f, 6).alias("f1_score"),
                        s.cast("bigint").alias("support"))

    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n,
            (f0 * s0 + f1 * s1) / n, n))
    return c.select(F.inline(rows))


def calibration_bins(df: DataFrame, score_col: str = "pd", label_col: str = "label",
                     n_bins: int = 10) -> DataFrame:
    """L-10 reliability curve: per uniform bin ([a, b), last closed) n, mean pd, observed rate."""
    p = F.col(score_col).cast("double")
    b = F.least(F.floor(p * n_bins), F.lit(n_bins - 1)).cast("int")
    return (df.where(p.isNotNull() & (p >= 0) & (p <= 1))
            .groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 F.avg(p).alias("mean_pd"), F.avg(F.col(label_col).cast("double")).alias("observed_rate")))


def reliability_curve(df: DataFrame, score_col: str = "pd", label_col: str = "label",
                      n_bins: int = 10) -> DataFrame:
    c = calibration_bins(df, score_col, label_col, n_bins)
    return c.select("bin", "n", F.round("mean_pd", 6).alias("mean_pd"),
                    F.round("observed_rate", 6).alias("observed_rate"))


def ece(df: DataFrame, score_col: str = "pd", label_col: str = "label", n_bins: int = 10) -> DataFrame:
    """L-9: Σ n_b / N · |observed_b − mean_pd_b| over non-empty bins (0 when empty)."""
    c = calibration_bins(df, score_col, label_col, n_bins)
    tot = F.sum("n")
    return c.agg(F.round(F.coalesce(
        F.sum(F.col("n") * F.abs(F.col("observed_rate") - F.col("mean_pd"))) / tot, F.lit(0.0)), 6)
        .alias("ece"), F.coalesce(tot, F.lit(0)).cast("bigint").alias("n"))


def prediction_error(df: DataFrame, actual_col: str = "y", pred_col: str = "yhat",
                     group_cols: list[str] | None = None) -> DataFrame:
    """M-10: MAE, RMSE and MAPE in percent (zero actuals excluded from MAPE)."""
    g = group_cols or []
    e = F.col(actual_col) - F.col(pred_col)
    ape = F.abs(e / F.nullif(F.col(actual_col), F.lit(0.0)))
    return df.groupBy(*[F.col(x) for x in g]).agg(
        F.round(F.avg(F.abs(e)), 6).alias("mae"),
        F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"),
        F.round(F.avg(ape) * 100, 6).alias("mape"))


def class_balance(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A-8: class counts, ``scale_pos_weight`` and balanced class weights n / (2·n_c)."""
    y = F.col(label_col)
    return df.agg(
        F.count_if(y == 1).cast("bigint").alias("n_pos"),
        F.count_if(y == 0).cast("bigint").alias("n_neg")).select(
        "n_pos", "n_neg",
        F.round(F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1)), 6).alias("scale_pos_weight"),
        F.round(F.try_divide(F.col("n_pos") + F.col("n_neg"), 2.0 * F.col("n_pos")), 6).alias("weight_pos"),
        F.round(F.try_divide(F.col("n_pos") + F.col("n_neg"), 2.0 * F.col("n_neg")), 6).alias("weight_neg"))
