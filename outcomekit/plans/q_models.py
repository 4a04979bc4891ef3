"""MLlib learner queries (M1-M16, T16): rows-only checks, except the
cross-validated closed-form learner, which has SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomekit.operators import bootstrap, classify, evaluate, stats
from outcomekit.operators.prep import gathered
from outcomekit.operators.split import stratified_folds
from outcomekit.plans import models, tuning
from outcomekit.plans.catalog import register, rounded
from outcomekit.plans.prepared import prepare
from outcomekit.plans.sql import with_cohort


def _learner_query(name):
    def run(spark, sf):
        p = prepare(spark, sf)
        m = models.fit_learner(name, p.train, p.features)
        return models.score(m, p.test, name)
    run.__name__ = f"q_{name}"
    return run


for _key, _name in [("model_logistic", "logistic_regression"), ("model_forest", "random_forest"),
                    ("model_gbt", "gradient_boosting"), ("model_gbt_weighted", "xgboost_like"),
                    ("model_gbt_unbalance", "lightgbm_like"), ("model_linear_svm", "linear_svm"),
                    ("model_mlp", "neural_network"), ("model_naive_bayes", "naive_bayes")]:
    register(_key)(_learner_query(_name))


@register("rf_importance")
def q_rf_importance(spark, sf):
    """Forest of 50 trees, seed 42, importance of every feature."""
    p = prepare(spark, sf)
    pipe = models.build_pipeline("forest", p.features, None, numTrees=50)
    m = pipe.fit(p.train)
    return rounded(models.importance_table(m, p.features, "random_forest_50", top=len(p.features)))


@register("combined_importance_forest")
def q_combined_forest(spark, sf):
    """Half F of the ANOVA, half importance in a forest of 50 trees."""
    p = prepare(spark, sf)
    m = models.build_pipeline("forest", p.features, None, numTrees=50).fit(p.train)
    forest = models.importance_table(m, p.features, "random_forest_50", top=len(p.features))
    f = stats.anova_f(stats.feature_moments(stats.long_form(p.train, p.features, "label")))
    feats = spark.createDataFrame([(x,) for x in p.features], "feature string")
    return rounded(stats.combined_importance(f, forest, "importance", feats))


@register("model_balanced_forest")
def q_balanced_forest(spark, sf):
    """30 deep trees, each on its own balanced bootstrap."""
    from pyspark.ml.feature import VectorAssembler
    p = prepare(spark, sf)
    asm = VectorAssembler(inputCols=p.features, outputCol="features")
    trees = bootstrap.fit_balanced_forest(asm.transform(p.train), 30, "stay_id")
    scored = bootstrap.forest_score(trees, asm.transform(p.test))
    return scored.select(F.lit("balanced_forest").alias("model"), "stay_id", "label", "score",
                         (F.col("score") > 0.5).cast("int").alias("prediction"))


@register("cv_learners")
def q_cv_learners(spark, sf):
    """3-fold stratified CV of every learner's preset, resampled inside the folds."""
    p = prepare(spark, sf)
    rows = stratified_folds(p.train.select("stay_id", "label", *p.features), "stay_id", "label", 3)
    return rounded(tuning.cross_validate(list(models.LEARNERS), rows, p.features))


@register("tuned_models")
def q_tuned(spark, sf):
    """M13 + M14: learners that pass the gate on a held-out split are tuned by
    20, 15 and 15 seeded draws of the full search spaces, on an outcome that the
    features tell something about."""
    p = prepare(spark, sf, outcome="many_lines")
    preds = None
    for name in tuning.GRIDS:
        s = models.score(models.fit_learner(name, p.train, p.features), p.test, name)
        preds = s if preds is None else preds.unionByName(s)
    rows = stratified_folds(p.train.select("stay_id", "label", *p.features), "stay_id", "label", 3)
    return rounded(tuning.tune_gated(evaluate.roc_auc(preds, ["model"]), rows, p.features, grids=tuning.GRIDS, draws=tuning.DRAWS))


@register("importance_table")
def q_importance(spark, sf):
    """Top-20 |coefficients| of the balanced logistic regression."""
    p = prepare(spark, sf)
    m = models.fit_learner("logistic_regression", p.train, p.features)
    return rounded(models.importance_table(m, p.features, "logistic_regression", top=20))


@register("random_search")
def q_random_search(spark, sf):
    """15 seeded draws from a logistic grid and 20, 15 and 15 from the search spaces of the
    other learners that are tuned; every draw in 3 stratified folds on AUC, the best of each
    learner refitted on all training rows, with its AUC on them."""
    p = prepare(spark, sf)
    rows = stratified_folds(p.train.select("stay_id", "label", *p.features), "stay_id", "label", 3).persist()
    train = gathered(rows)
    grid = {"regParam": [0.0, 0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [50, 100]}
    try:
        best, table = models.random_search(train, p.features, "logistic", grid, n_draws=15, folds=3, fold_col="fold")
        draws = table.orderBy("draw").collect()                          # a row a draw
        win = max(draws, key=lambda r: (r.mean_auc, -r.draw)).draw
        found = [("logistic_regression", r.draw, r.params, r.mean_auc, r.draw == win) for r in draws]
        fitted = {"logistic_regression": best}
        for name, space in tuning.GRIDS.items():
            fitted[name], draws = tuning.tune(name, train, p.features, tuning.draw_settings(space, tuning.DRAWS[name]), discard=False)
            found += [(name, draw, params, mean, status == "best") for draw, params, _, mean, status in draws]
        auc = {name: evaluate.roc_auc(models.score(m, train, name), ["model"]).first()["auc"] for name, m in fitted.items()}
    finally:
        rows.unpersist()
    out = [(name, draw, params, mean, "best" if won else "complete", auc[name] if won else None) for name, draw, params, mean, won in found]
    return rounded(spark.createDataFrame(out, "model string, draw int, params string, mean_auc double, status string, train_auc double"))


@register("model_comparison")
def q_model_comparison(spark, sf):
    """M10 + E1-E3: every learner fitted and scored, failures isolated."""
    p = prepare(spark, sf)
    preds, errors = models.fit_and_score(list(models.LEARNERS), p.train, p.test, p.features)
    preds = preds.cache()
    metrics = evaluate.class_metrics(evaluate.confusion(preds, ["model"])).join(
        evaluate.roc_auc(preds, ["model"]), "model")
    out = metrics.join(errors, "model", "full")
    return rounded(out.select("model", "accuracy", "precision", "recall", "f1", "auc", "error"))


H13 = "CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 13)) AS BIGINT)"

CV_SQL = with_cohort(f"""
, folds AS (SELECT stay_id, label,
                   CAST((row_number() OVER (PARTITION BY label ORDER BY {H13.format(k='stay_id')}, stay_id) - 1) % 3 AS INTEGER) AS fold
            FROM prepared WHERE split = 'train')
, tf AS (SELECT t.stay_id, t.label, t.feature, t.value, f.fold FROM train t JOIN folds f ON t.stay_id = f.stay_id)
, held AS (SELECT DISTINCT fold AS h FROM folds)
, cvfit AS (SELECT h.h, tf.label, tf.feature, avg(value) AS mu, var_pop(value) AS v
            FROM tf JOIN held h ON tf.fold <> h.h GROUP BY h.h, tf.label, tf.feature)
, cveps AS (SELECT h, 1e-9 * max(v) AS eps FROM (SELECT h.h, tf.feature, var_pop(value) AS v
            FROM tf JOIN held h ON tf.fold <> h.h GROUP BY h.h, tf.feature) GROUP BY h)
, cvprior AS (SELECT h.h, f.label, count(*) / sum(count(*)) OVER (PARTITION BY h.h) AS prior
              FROM folds f JOIN held h ON f.fold <> h.h GROUP BY h.h, f.label)
, cvjll AS (SELECT tf.fold AS h, tf.stay_id, c.label AS cls,
                   sum(-0.5 * ln(2 * pi() * (c.v + e.eps)) - 0.5 * (tf.value - c.mu) ^ 2 / (c.v + e.eps)) AS s
            FROM tf JOIN cvfit c ON c.h = tf.fold AND c.feature = tf.feature JOIN cveps e ON e.h = tf.fold
            GROUP BY tf.fold, tf.stay_id, c.label)
, cvscore AS (SELECT j0.h, j0.stay_id, f.label,
                     round((j1.s + ln(p1.prior)) - (j0.s + ln(p0.prior)), 9) AS margin
              FROM cvjll j0 JOIN cvjll j1 ON j0.stay_id = j1.stay_id AND j0.cls = 0 AND j1.cls = 1
              JOIN cvprior p0 ON p0.h = j0.h AND p0.label = 0 JOIN cvprior p1 ON p1.h = j0.h AND p1.label = 1
              JOIN folds f ON f.stay_id = j0.stay_id)
, cvsc AS (SELECT h, margin, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
           FROM cvscore GROUP BY h, margin)
, cvcurve AS (SELECT h, pos, neg,
    sum(neg) OVER (PARTITION BY h ORDER BY margin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
    sum(pos) OVER (PARTITION BY h) AS P, sum(neg) OVER (PARTITION BY h) AS N FROM cvsc)
, cvauc AS (SELECT h AS fold, sum(pos * (N - cum_neg + 0.5 * neg)) / (any_value(P) * any_value(N)) AS auc
            FROM cvcurve GROUP BY h)
SELECT fold, round(auc, 6) AS auc, round(avg(auc) OVER (), 6) AS mean_auc, round(stddev_pop(auc) OVER (), 6) AS std_auc
FROM cvauc""".replace("\n, folds AS", ", folds AS", 1))


@register("cv_fold_metrics", CV_SQL)
def q_cv(spark, sf):
    """M11 + M12: 3-fold stratified CV of the closed-form naive Bayes; per-fold
    AUC, mean and population std."""
    from pyspark.sql import Window
    p = prepare(spark, sf)
    tr = stratified_folds(p.train, "stay_id", "label", 3).cache()
    parts = []
    for f in range(3):
        fit = classify.fit_gaussian_nb(tr.where(F.col("fold") != f), p.features)
        held = classify.apply_gaussian_nb(tr.where(F.col("fold") == f), fit, p.features) \
            .select(F.lit(f).alias("fold"), "label", F.round("margin", 9).alias("margin"))
        parts.append(held)
    scored = parts[0]
    for x in parts[1:]:
        scored = scored.unionByName(x)
    auc = evaluate.roc_auc(scored, ["fold"], score="margin")
    w = Window.partitionBy()  # three rows
    return rounded(auc.select(F.col("fold").cast("int").alias("fold"), "auc",
                              F.avg("auc").over(w).alias("mean_auc"), F.stddev_pop("auc").over(w).alias("std_auc")))
