"""Binary-classifier evaluation (E1-E11) on a prediction table
``(by.., label, score[, prediction])``.

Counts are grouped aggregates.  Curves first collapse rows to distinct
scores per group — (by, score, pos, neg) — so a score shared by a third of
the rows is one row; running totals over the score order are range-bucketed
(``functions.prefix``), so no single task sorts the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomekit.functions.expr import safe_div
from outcomekit.functions.prefix import neighbours_in_order, running_totals


def _z(c: Column) -> Column:
    """zero-division -> 0 (scikit-learn ``zero_division=0``)."""
    return F.coalesce(c, F.lit(0.0))


def confusion(preds: DataFrame, by: list[str], label: str = "label", pred: str = "prediction") -> DataFrame:
    """Tn, fp, fn, tp per group."""
    y, p = F.col(label), F.col(pred)
    return preds.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def class_metrics(conf: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 from confusion counts."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    prec = _z(safe_div(tp, tp + fp))
    rec = _z(safe_div(tp, tp + fn))
    return conf.withColumns({
        "accuracy": _z(safe_div(tp + tn, tp + tn + fp + fn)),
        "precision": prec,
        "recall": rec,
        "f1": _z(safe_div(2 * tp, 2 * tp + fp + fn)),
    })


def score_counts(preds: DataFrame, by: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """(by.., score, pos, neg): one row per distinct score."""
    return preds.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def _curve(preds: DataFrame, by: list[str], label: str, score: str) -> DataFrame:
    """Distinct-score table with descending running pos / neg and group totals.
    ``by`` must name at least one column (use a constant column for one group)."""
    if not by:
        raise ValueError("give at least one grouping column, e.g. the model name")
    # read by the running totals (four times) and the group totals: keep it
    # (MEMORY_AND_DISK; lost blocks are recomputed)
    sc = score_counts(preds, by, label, score).cache()
    cum = running_totals(sc, "score", ["pos", "neg"], by=by, descending=True)
    # one row per group (model): a dimension table
    tot = sc.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return cum.join(F.broadcast(tot), by)


def roc_auc(preds: DataFrame, by: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """Rank-sum AUC with half credit for ties."""
    c = _curve(preds, by, label, score)
    part = F.col("pos").cast("double") * (F.col("N") - F.col("cum_neg") + 0.5 * F.col("neg"))
    # positives x negatives passes the range of a long at a few billion rows each
    pairs = F.first("P").cast("double") * F.first("N").cast("double")
    return c.groupBy(*by).agg(safe_div(F.sum(part), pairs).alias("auc"))


def roc_curve(preds: DataFrame, by: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, descending, plus the
    (0, 0) start at threshold +inf.  No collinear-point dropping."""
    c = _curve(preds, by, label, score)
    pts = c.select(*by, F.col("score").alias("threshold"),
                   safe_div(F.col("cum_neg").cast("double"), F.col("N").cast("double")).alias("fpr"),
                   safe_div(F.col("cum_pos").cast("double"), F.col("P").cast("double")).alias("tpr"))
    start = preds.select(*by).distinct().select(*by, F.lit(float("inf")).alias("threshold"),
                                                 F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def roc_corners(preds: DataFrame, by: list[str], label: str = "label", score: str = "score",
                rows_per_range: int = 500_000) -> DataFrame:
    """``roc_curve`` without its collinear points (scikit-learn's
    ``drop_intermediate``): a point goes where the step to it and the step from
    it add the same positives and the same negatives.  The first and the last
    score and the start at +inf stay; the area is that of the whole curve."""
    c = _curve(preds, by, label, score).cache()     # read four times
    near = neighbours_in_order(c, "score", ["pos", "neg"], by, rows_per_range=rows_per_range)
    same = (F.col("pos") == F.col("next_pos")) & (F.col("neg") == F.col("next_neg")) & F.col("prev_pos").isNotNull()
    pts = near.where(~F.coalesce(same, F.lit(False))).select(
        *by, F.col("score").alias("threshold"),
        safe_div(F.col("cum_neg").cast("double"), F.col("N").cast("double")).alias("fpr"),
        safe_div(F.col("cum_pos").cast("double"), F.col("P").cast("double")).alias("tpr"))
    start = preds.select(*by).distinct().select(*by, F.lit(float("inf")).alias("threshold"),
                                                 F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def youden_threshold(roc: DataFrame, by: list[str]) -> DataFrame:
    """E5: argmax(tpr - fpr) over all points of the curve, the one at +inf
    (nothing is positive) included; ties -> the highest threshold."""
    j = F.col("tpr") - F.col("fpr")
    return roc.groupBy(*by).agg(
        F.max_by("threshold", F.struct(j, F.col("threshold"))).alias("threshold"),
        F.max(j).alias("youden_j"))


def apply_threshold(preds: DataFrame, thr: DataFrame, by: list[str], score: str = "score",
                    out: str = "prediction") -> DataFrame:
    """prediction = score >= threshold (threshold table: one row per group)."""
    t = thr.select(*by, F.col("threshold").alias("_thr"))
    j = preds.join(F.broadcast(t), by)
    return j.withColumn(out, (F.col(score) >= F.col("_thr")).cast("int")).drop("_thr")


def pr_curve(preds: DataFrame, by: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) from the highest score down to the
    first threshold reaching full recall, plus the (recall 0, precision 1) end."""
    c = _curve(preds, by, label, score)
    pts = c.where((F.col("cum_pos") - F.col("pos") < F.col("P")) | (F.col("P") == 0)).select(
        *by, F.col("score").alias("threshold"),
        safe_div(F.col("cum_pos").cast("double"), (F.col("cum_pos") + F.col("cum_neg")).cast("double")).alias("precision"),
        safe_div(F.col("cum_pos").cast("double"), F.col("P").cast("double")).alias("recall"))
    end = preds.select(*by).distinct().select(*by, F.lit(None).cast("double").alias("threshold"),
                                               F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(preds: DataFrame, by: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """E8 + E9: step-sum AP = sum (R_n - R_n-1) P_n and the prevalence baseline."""
    c = _curve(preds, by, label, score)
    prec = safe_div(F.col("cum_pos").cast("double"), (F.col("cum_pos") + F.col("cum_neg")).cast("double"))
    return c.groupBy(*by).agg(
        safe_div(F.sum(F.col("pos") * prec), F.first("P").cast("double")).alias("average_precision"),
        safe_div(F.first("P").cast("double"), (F.first("P") + F.first("N")).cast("double")).alias("baseline"))


def class_report(conf: DataFrame, by: list[str]) -> DataFrame:
    """Per class precision / recall / F1 / support, then macro and
    weighted averages (rows keyed by ``row``)."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))

    def cls(name, t, f_p, f_n):
        p = _z(safe_div(t, t + f_p))
        r = _z(safe_div(t, t + f_n))
        f = _z(safe_div(2 * t, 2 * t + f_p + f_n))
        return conf.select(*by, F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"),
                           f.alias("f1"), (t + f_n).cast("bigint").alias("support"))
    c0 = cls("0", tn, fn, fp)
    c1 = cls("1", tp, fp, fn)
    both = c0.unionByName(c1)
    macro = both.groupBy(*by).agg(F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
                                  F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                                  F.sum("support").cast("bigint").alias("support"))
    w = F.col("support").cast("double")
    weighted = both.groupBy(*by).agg(
        F.lit("weighted avg").alias("row"),
        safe_div(F.sum(F.col("precision") * w), F.sum(w)).alias("precision"),
        safe_div(F.sum(F.col("recall") * w), F.sum(w)).alias("recall"),
        safe_div(F.sum(F.col("f1") * w), F.sum(w)).alias("f1"),
        F.sum("support").cast("bigint").alias("support"))
    return both.unionByName(macro).unionByName(weighted)
