import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from outcomekit.operators import classify, evaluate, stats


def _data(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    x = rng.normal(size=n) + 0.7 * y
    z = rng.normal(size=n) * (1 + y)
    return spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(y, x, z)],
                                 "label int, x double, z double"), y, x, z


def test_anova_equals_pooled_t_squared(spark):
    df, *_ = _data(spark)
    m = stats.feature_moments(stats.long_form(df, ["x", "z"], "label"))
    f = {r.feature: r for r in stats.anova_f(m).collect()}
    t = {r.feature: r for r in stats.t_tests(m).collect()}
    for k in ("x", "z"):
        assert f[k].f_value == pytest.approx(t[k].t_pooled ** 2, rel=1e-9)
        assert f[k].p_value == pytest.approx(t[k].p_pooled, rel=1e-9)


def test_levene_against_numpy(spark):
    df, y, _, z = _data(spark)
    lev = stats.levene(stats.long_form(df, ["z"], "label")).first()
    g = [np.abs(z[y == c] - np.median(z[y == c])) for c in (0, 1)]
    n = len(z)
    zbar = np.concatenate(g).mean()
    between = sum(len(a) * (a.mean() - zbar) ** 2 for a in g)
    within = sum(((a - a.mean()) ** 2).sum() for a in g)
    assert lev.levene_w == pytest.approx((n - 2) * between / within, rel=1e-9)


def test_auc_matches_mllib_and_is_antisymmetric(spark):
    df, y, x, _ = _data(spark)
    p = df.select(F.lit("m").alias("model"), "label", F.round("x", 2).alias("score"))
    auc = evaluate.roc_auc(p, ["model"]).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC")
    assert auc == pytest.approx(ev.evaluate(p.withColumn("label", F.col("label").cast("double"))), abs=1e-9)
    neg = evaluate.roc_auc(p.withColumn("score", -F.col("score")), ["model"]).first().auc
    assert auc + neg == pytest.approx(1.0, abs=1e-12)
    assert 0.0 <= auc <= 1.0


def test_margin_ranks_where_probabilities_run_together(spark):
    """Scores of 1 - 1e-20 and 1 - 1e-30 are one double; their log-odds aren't."""
    train = spark.createDataFrame([(i, i % 2, (i % 2) * 100.0 + i % 5) for i in range(40)], "stay_id long, label int, x double")
    rows = spark.createDataFrame([(1, 0, 90.0), (2, 1, 150.0), (3, 0, 80.0), (4, 1, 120.0)], "stay_id long, label int, x double")
    out = classify.apply_gaussian_nb(rows, classify.fit_gaussian_nb(train, ["x"]), ["x"]).withColumn("model", F.lit("m"))
    got = {r.stay_id: r for r in out.collect()}
    assert {r.score for r in got.values()} == {1.0}
    assert got[3].margin < got[1].margin < got[4].margin < got[2].margin
    assert evaluate.roc_auc(out, ["model"]).first().auc == 0.5
    assert evaluate.roc_auc(out, ["model"], score="margin").first().auc == 1.0
