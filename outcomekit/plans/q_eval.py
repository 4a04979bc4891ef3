"""Evaluation and report queries (M8, E1-E11, R1-R9, J7) over two closed-form
scorers (Gaussian naive Bayes, nearest centroid) so every metric has SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomekit.operators import classify, evaluate, report
from outcomekit.plans.catalog import register, rounded
from outcomekit.plans.prepared import prepare
from outcomekit.plans.sql import many_lines, with_cohort
from outcomekit.plans.tuning import gate

BY = ["model"]


def _scored(spark, sf, on: str = "test", outcome: str = "urgent"):
    """model, stay_id, label, margin, score, prediction.  Rows are ranked by the
    margin (log-odds, which don't saturate); its 9 places only take off what
    the order of a sum adds."""
    p = prepare(spark, sf, outcome=outcome)
    rows = p.test if on == "test" else p.train
    nb = classify.fit_gaussian_nb(p.train, p.features)
    ce = classify.fit_centroids(p.train, p.features)
    a = classify.apply_gaussian_nb(rows, nb, p.features).select(F.lit("gaussian_nb").alias("model"), "stay_id", "label", "margin")
    b = classify.apply_centroids(rows, ce, p.features).select(F.lit("centroid").alias("model"), "stay_id", "label", "margin")
    s = a.unionByName(b).withColumn("margin", F.round("margin", 9))
    return s.withColumn("score", _probability("margin")).withColumn("prediction", (F.col("margin") > 0).cast("int"))


def _probability(margin: str):
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col(margin))), 9)


def _thresholds(df):
    """Thresholds on the margin as probabilities; the one at +inf (nothing is positive) stays."""
    t = F.col("threshold")
    return df.withColumn("threshold", F.when(t == float("inf"), t).otherwise(_probability("threshold")))


THRESHOLD = """CASE WHEN threshold = CAST('inf' AS DOUBLE) THEN threshold
            ELSE round(1.0 / (1.0 + exp(-threshold)), 9) END"""


SCORE_CTES = """
, nbfit AS (SELECT label, feature, avg(value) AS mu, var_pop(value) AS v FROM train GROUP BY label, feature)
, nbeps AS (SELECT 1e-9 * max(v) AS eps FROM (SELECT feature, var_pop(value) AS v FROM train GROUP BY feature))
, nbprior AS (SELECT label, count(*) / sum(count(*)) OVER () AS prior
              FROM (SELECT DISTINCT stay_id, label FROM train) GROUP BY label)
, cefit AS (SELECT label, feature, avg(value) AS mu FROM train GROUP BY label, feature)
, cescale AS (SELECT feature, CASE WHEN stddev_pop(value) = 0 OR stddev_pop(value) IS NULL THEN 1.0
                                  ELSE stddev_pop(value) END AS scale FROM train GROUP BY feature)
, rows_{on} AS (SELECT * FROM {on})
, nbjll AS (
  SELECT r.stay_id, f.label AS cls,
         sum(-0.5 * ln(2 * pi() * (f.v + e.eps)) - 0.5 * (r.value - f.mu) ^ 2 / (f.v + e.eps)) AS s
  FROM rows_{on} r JOIN nbfit f ON r.feature = f.feature CROSS JOIN nbeps e GROUP BY r.stay_id, f.label)
, cedist AS (
  SELECT r.stay_id, f.label AS cls, sum(((r.value - f.mu) / s.scale) ^ 2) AS d2
  FROM rows_{on} r JOIN cefit f ON r.feature = f.feature JOIN cescale s ON r.feature = s.feature
  GROUP BY r.stay_id, f.label)
, ylab AS (SELECT DISTINCT stay_id, label FROM rows_{on})
, scored AS (
  SELECT 'gaussian_nb' AS model, y.stay_id, y.label,
         round((j1.s + ln(p1.prior)) - (j0.s + ln(p0.prior)), 9) AS margin
  FROM ylab y JOIN nbjll j0 ON y.stay_id = j0.stay_id AND j0.cls = 0
  JOIN nbjll j1 ON y.stay_id = j1.stay_id AND j1.cls = 1
  CROSS JOIN (SELECT prior FROM nbprior WHERE label = 0) p0 CROSS JOIN (SELECT prior FROM nbprior WHERE label = 1) p1
  UNION ALL
  SELECT 'centroid', y.stay_id, y.label, round(d0.d2 - d1.d2, 9)
  FROM ylab y JOIN cedist d0 ON y.stay_id = d0.stay_id AND d0.cls = 0
  JOIN cedist d1 ON y.stay_id = d1.stay_id AND d1.cls = 1)
, preds AS (SELECT *, round(1.0 / (1.0 + exp(-margin)), 9) AS score, CAST(margin > 0 AS INTEGER) AS prediction FROM scored)
, conf AS (SELECT model, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
                 count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
                 count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
                 count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM preds GROUP BY model)
, metrics AS (SELECT model, tn, fp, fn, tp,
    CAST(tp + tn AS DOUBLE) / nullif(tp + tn + fp + fn, 0) AS accuracy,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall,
    coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM conf)
, sc AS (SELECT model, margin, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
         FROM preds GROUP BY model, margin)
, curve AS (SELECT model, margin, pos, neg,
    sum(pos) OVER (PARTITION BY model ORDER BY margin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
    sum(neg) OVER (PARTITION BY model ORDER BY margin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
    sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N FROM sc)
, auc AS (SELECT model, sum(pos * (N - cum_neg + 0.5 * neg)) / (any_value(P) * any_value(N)) AS auc
          FROM curve GROUP BY model)
, roc AS (SELECT model, margin AS threshold, CAST(cum_neg AS DOUBLE) / N AS fpr, CAST(cum_pos AS DOUBLE) / P AS tpr FROM curve
          UNION ALL SELECT DISTINCT model, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM preds)
, youden AS (SELECT model, arg_max(threshold, (tpr - fpr, threshold)) AS threshold, max(tpr - fpr) AS youden_j
             FROM roc GROUP BY model)
"""


def _sql(body: str, on: str = "test") -> str:
    return with_cohort(SCORE_CTES.replace("{on}", on).replace("\n, ", ",\n", 1).rstrip() + "\n" + body)


@register("gaussian_nb", _sql("SELECT model, stay_id, label, score, prediction FROM preds WHERE model = 'gaussian_nb'"))
def q_gnb(spark, sf):
    return _scored(spark, sf).where(F.col("model") == "gaussian_nb").drop("margin")


@register("centroid_scores", _sql("SELECT model, stay_id, label, score, prediction FROM preds WHERE model = 'centroid'"))
def q_centroid(spark, sf):
    return _scored(spark, sf).where(F.col("model") == "centroid").drop("margin")


@register("confusion_counts", _sql("SELECT model, tn, fp, fn, tp FROM conf"))
def q_confusion(spark, sf):
    return evaluate.confusion(_scored(spark, sf), BY)


METRIC_COLS = "round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1"


@register("class_metrics", _sql(f"SELECT model, tn, fp, fn, tp, {METRIC_COLS} FROM metrics"))
def q_class_metrics(spark, sf):
    return rounded(evaluate.class_metrics(evaluate.confusion(_scored(spark, sf), BY)))


@register("roc_auc", _sql("SELECT model, round(auc, 6) AS auc FROM auc"))
def q_auc(spark, sf):
    return rounded(evaluate.roc_auc(_scored(spark, sf), BY, score="margin"))


@register("roc_auc_train", _sql("SELECT model, round(auc, 6) AS auc FROM auc", on="train"))
def q_auc_train(spark, sf):
    return rounded(evaluate.roc_auc(_scored(spark, sf, "train"), BY, score="margin"))


@register("roc_curve", _sql(f"SELECT model, {THRESHOLD} AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM roc"))
def q_roc(spark, sf):
    return rounded(_thresholds(evaluate.roc_curve(_scored(spark, sf), BY, score="margin")), keep=("threshold",))


@register("roc_corners", _sql(f"""
, steps AS (SELECT *, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, lag(pos) OVER w AS prev_pos
            FROM curve WINDOW w AS (PARTITION BY model ORDER BY margin DESC))
, corners AS (SELECT model, margin AS threshold, CAST(cum_neg AS DOUBLE) / N AS fpr, CAST(cum_pos AS DOUBLE) / P AS tpr FROM steps
              WHERE prev_pos IS NULL OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg
              UNION ALL SELECT DISTINCT model, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM preds)
SELECT model, {THRESHOLD} AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM corners"""))
def q_corners(spark, sf):
    return rounded(_thresholds(evaluate.roc_corners(_scored(spark, sf), BY, score="margin")), keep=("threshold",))


@register("youden_threshold", _sql(f"SELECT model, {THRESHOLD} AS threshold, round(youden_j, 6) AS youden_j FROM youden"))
def q_youden(spark, sf):
    best = evaluate.youden_threshold(evaluate.roc_curve(_scored(spark, sf), BY, score="margin"), BY)
    return rounded(_thresholds(best), keep=("threshold",))


@register("threshold_predict", _sql(f"""
SELECT p.model, {THRESHOLD} AS threshold,
       count(*) FILTER (WHERE label = 0 AND margin < threshold) AS tn,
       count(*) FILTER (WHERE label = 0 AND margin >= threshold) AS fp,
       count(*) FILTER (WHERE label = 1 AND margin < threshold) AS fn,
       count(*) FILTER (WHERE label = 1 AND margin >= threshold) AS tp
FROM preds p JOIN youden y ON p.model = y.model GROUP BY p.model, y.threshold"""))
def q_threshold_predict(spark, sf):
    s = _scored(spark, sf).drop("prediction")
    thr = evaluate.youden_threshold(evaluate.roc_curve(s, BY, score="margin"), BY)
    applied = evaluate.apply_threshold(s, thr, BY, score="margin")
    return evaluate.confusion(applied, BY).join(_thresholds(thr).select("model", "threshold"), "model") \
        .select("model", "threshold", "tn", "fp", "fn", "tp")


@register("pr_curve", _sql("""
SELECT model, round(1.0 / (1.0 + exp(-margin)), 9) AS threshold, round(CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg), 6) AS precision,
       round(CAST(cum_pos AS DOUBLE) / P, 6) AS recall
FROM curve WHERE cum_pos - pos < P OR P = 0
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1.0, 0.0 FROM preds"""))
def q_pr(spark, sf):
    return rounded(_thresholds(evaluate.pr_curve(_scored(spark, sf), BY, score="margin")), keep=("threshold",))


@register("average_precision", _sql("""
SELECT model, round(sum(pos * CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg)) / any_value(P), 6) AS average_precision,
       round(CAST(any_value(P) AS DOUBLE) / (any_value(P) + any_value(N)), 6) AS baseline
FROM curve GROUP BY model"""))
def q_ap(spark, sf):
    return rounded(evaluate.average_precision(_scored(spark, sf), BY, score="margin"))


@register("class_report", _sql("""
, cls AS (
  SELECT model, '0' AS "row", coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0.0) AS precision,
         coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0.0) AS recall,
         coalesce(CAST(2 * tn AS DOUBLE) / nullif(2 * tn + fn + fp, 0), 0.0) AS f1, tn + fp AS support FROM conf
  UNION ALL
  SELECT model, '1', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0),
         coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0),
         coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0), tp + fn FROM conf)
, allrows AS (
  SELECT * FROM cls
  UNION ALL SELECT model, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM cls GROUP BY model
  UNION ALL SELECT model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM cls GROUP BY model)
SELECT model, "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM allrows""".replace("\n, cls AS", ", cls AS", 1)))
def q_class_report(spark, sf):
    return rounded(evaluate.class_report(evaluate.confusion(_scored(spark, sf), BY), BY))


def _metric_table(spark, sf, outcome: str = "urgent"):
    s = _scored(spark, sf, outcome=outcome)
    m = evaluate.class_metrics(evaluate.confusion(s, BY))
    return m.join(evaluate.roc_auc(s, BY, score="margin"), "model")


MT_CTE = """
, mt AS (SELECT m.*, a.auc FROM metrics m JOIN auc a ON m.model = a.model)"""


def _sqlm(body: str) -> str:
    return _sql(MT_CTE + "\n" + body)


ROUND5 = METRIC_COLS + ", round(auc, 6) AS auc"


@register("rank_models", _sqlm(f"""SELECT model, {ROUND5}, row_number() OVER (ORDER BY auc DESC, model) AS rank FROM mt"""))
def q_rank(spark, sf):
    return rounded(report.rank_models(_metric_table(spark, sf)).select(
        "model", "accuracy", "precision", "recall", "f1", "auc", F.col("rank").cast("bigint").alias("rank")))


@register("best_model", _sqlm(f"SELECT model, {ROUND5} FROM mt ORDER BY auc DESC, model LIMIT 1"))
def q_best(spark, sf):
    return rounded(report.best_model(_metric_table(spark, sf)).select(
        "model", "accuracy", "precision", "recall", "f1", "auc"))


LB_CTE = MT_CTE + """
, lb AS (
  SELECT model, 'accuracy' AS metric, accuracy AS value, 1 AS metric_pos FROM mt
  UNION ALL SELECT model, 'precision', precision, 2 FROM mt
  UNION ALL SELECT model, 'recall', recall, 3 FROM mt
  UNION ALL SELECT model, 'f1', f1, 4 FROM mt
  UNION ALL SELECT model, 'auc', auc, 5 FROM mt)"""


@register("unpivot_metrics", _sql(LB_CTE + "\nSELECT model, metric, round(value, 6) AS value, metric_pos FROM lb"))
def q_unpivot(spark, sf):
    return rounded(report.unpivot_metrics(_metric_table(spark, sf)))


@register("metric_leaderboard", _sql(LB_CTE + """
SELECT model, metric, round(value, 6) AS value, metric_pos,
       row_number() OVER (PARTITION BY metric ORDER BY value DESC, model) AS position FROM lb"""))
def q_leaderboard(spark, sf):
    out = report.leaderboard(_metric_table(spark, sf))
    return rounded(out.withColumn("position", F.col("position").cast("bigint")))


@register("pivot_metrics", _sql(LB_CTE + f"""
SELECT model,
       round(max(value) FILTER (WHERE metric = 'accuracy'), 6) AS accuracy,
       round(max(value) FILTER (WHERE metric = 'precision'), 6) AS precision,
       round(max(value) FILTER (WHERE metric = 'recall'), 6) AS recall,
       round(max(value) FILTER (WHERE metric = 'f1'), 6) AS f1,
       round(max(value) FILTER (WHERE metric = 'auc'), 6) AS auc
FROM lb GROUP BY model"""))
def q_pivot(spark, sf):
    long = report.unpivot_metrics(_metric_table(spark, sf))
    return rounded(report.pivot_metrics(long))


BANDS_SQL = """CASE WHEN auc > 0.8 THEN 'good' WHEN auc > 0.7 THEN 'moderate' ELSE 'weak' END AS auc_band,
       CASE WHEN precision > 0.8 THEN 'high' WHEN precision > 0.6 THEN 'medium' ELSE 'low' END AS precision_band,
       CASE WHEN recall > 0.7 THEN 'high' WHEN recall > 0.5 THEN 'medium' ELSE 'low' END AS recall_band"""


@register("metric_bands", _sqlm(f"SELECT model, {BANDS_SQL} FROM mt"))
def q_bands(spark, sf):
    return report.bands(_metric_table(spark, sf))


@register("metric_display", _sqlm("""
SELECT model, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision, round(recall, 4) AS recall,
       round(f1, 4) AS f1, round(auc, 4) AS auc FROM mt"""))
def q_display(spark, sf):
    cols = ["accuracy", "precision", "recall", "f1", "auc"]
    return report.display(_metric_table(spark, sf), cols, 4).select("model", *cols)


@register("threshold_table", _sql(f"SELECT model, {THRESHOLD} AS best_threshold FROM youden"))
def q_threshold_table(spark, sf):
    s = _scored(spark, sf)
    return _thresholds(evaluate.youden_threshold(evaluate.roc_curve(s, BY, score="margin"), BY)).select(
        "model", F.col("threshold").alias("best_threshold"))


@register("final_report", _sqlm(f"""
, best AS (SELECT * FROM mt ORDER BY auc DESC, model LIMIT 1)
SELECT b.model, {ROUND5.replace('round(', 'round(b.')}, b.tn, b.fp, b.fn, b.tp,
       {BANDS_SQL.replace('auc >', 'b.auc >').replace('precision >', 'b.precision >').replace('recall >', 'b.recall >')},
       round(ap.average_precision, 6) AS average_precision
FROM best b JOIN (SELECT model, sum(pos * CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg)) / any_value(P) AS average_precision
                  FROM curve GROUP BY model) ap ON b.model = ap.model""".replace("\n, best AS", ", best AS", 1)))
def q_final_report(spark, sf):
    s = _scored(spark, sf)
    m = evaluate.class_metrics(evaluate.confusion(s, BY)).join(evaluate.roc_auc(s, BY, score="margin"), "model")
    best = report.best_model(m)
    out = best.join(report.bands(m), "model").join(
        evaluate.average_precision(s, BY, score="margin").select("model", "average_precision"), "model")
    return rounded(out.select("model", "accuracy", "precision", "recall", "f1", "auc", "tn", "fp", "fn", "tp",
                              "auc_band", "precision_band", "recall_band", "average_precision"))


@register("gate_models", _sqlm(f"SELECT model, round(auc, 6) AS auc FROM mt WHERE auc > 0.7"))
def q_gate(spark, sf):
    """Only models whose AUC clears 0.7 go on to tuning."""
    return rounded(gate(_metric_table(spark, sf)).select("model", "auc"))


@register("gate_many_lines", many_lines(_sqlm("SELECT model, round(auc, 6) AS auc FROM mt WHERE auc > 0.7")))
def q_gate_many_lines(spark, sf):
    """M14 on an outcome that the features tell something about."""
    return rounded(gate(_metric_table(spark, sf, "many_lines")).select("model", "auc"))


@register("metrics_json", _sqlm(f"SELECT model, {ROUND5} FROM mt"))
def q_metrics_json(spark, sf):
    """Metrics serialised with to_json and read back field by field."""
    from outcomekit.sources.sinks import metrics_to_json
    m = _metric_table(spark, sf).select("model", "accuracy", "precision", "recall", "f1", "auc")
    js = metrics_to_json(m)
    schema = "accuracy double, precision double, recall double, f1 double, auc double"
    back = js.select("model", F.from_json("metrics_json", schema).alias("m")).select("model", "m.*")
    return rounded(back)
