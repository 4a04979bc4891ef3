"""Resampling inside folds, tuner with gate, balanced bootstraps."""

import math
import statistics

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from outcomekit.operators import balance, bootstrap, evaluate
from outcomekit.operators.split import stratified_folds
from outcomekit.plans import models, tuning
from outcomekit.sources.sinks import load_models

SMALL = {"random_forest": {"numTrees": 5, "maxDepth": 4}, "gradient_boosting": {"maxIter": 3, "maxDepth": 3},
         "logistic_regression": {"maxIter": 20}}
COLS = ["x", "y", "z"]


def separable(spark, n=240, seed=3, noise=0.4):
    """A third of class 1; ``x`` tells the classes apart but for some noise."""
    rng = np.random.default_rng(seed)
    label = (np.arange(n) % 3 == 0).astype(int)
    x = label * 2 + rng.normal(0, noise, n)
    rows = [(i, int(c), float(a), float(rng.normal()), float(rng.normal())) for i, (c, a) in enumerate(zip(label, x))]
    return spark.createDataFrame(rows, "stay_id long, label int, x double, y double, z double").repartition(2)


def test_folds_keep_rows_that_share_a_key(spark):
    df = separable(spark, 60)
    df = df.union(df.where("stay_id < 5"))
    folded = stratified_folds(df, "stay_id", "label", 3)
    assert folded.count() == 65 and folded.columns == [*df.columns, "fold"]
    sizes = {(r.label, r.fold): r["count"] for r in folded.groupBy("label", "fold").count().collect()}
    for c in (0, 1):
        counts = [sizes[c, f] for f in range(3)]
        assert max(counts) - min(counts) <= 1


def test_cross_validation_resamples_inside_folds(spark, monkeypatch):
    rows = stratified_folds(separable(spark), "stay_id", "label", 3).cache()
    fold_of = {r.stay_id: r.fold for r in rows.collect()}
    seen, plain = [], balance.smote

    def spy(df, *args, **kw):
        out, nn = plain(df, *args, **kw)
        ids = {r.stay_id for r in out.where("is_synthetic").collect()} | {i for r in nn.collect() for i in (r.stay_id, r.nn_id)}
        seen.append(({r.stay_id for r in df.select("stay_id").collect()}, ids))
        return out, nn

    monkeypatch.setattr(models.balance, "smote", spy)
    cv = tuning.cross_validate(["gradient_boosting", "logistic_regression"], rows, COLS, overrides=SMALL).collect()
    assert len(seen) == 4                                # three folds and the refit
    for i in range(3):
        given, used = seen[i]
        assert {fold_of[s] for s in given} == {0, 1, 2} - {i} and used and used <= given
    assert {(r.model, r.fold) for r in cv} == {(m, f) for m in ("gradient_boosting", "logistic_regression") for f in range(3)}
    for name in ("gradient_boosting", "logistic_regression"):
        mine = [r for r in cv if r.model == name]
        for value in ("auc", "f1"):
            got = [r[value] for r in mine]
            assert mine[0][f"mean_{value}"] == pytest.approx(statistics.mean(got))
            assert mine[0][f"std_{value}"] == pytest.approx(statistics.pstdev(got), abs=1e-9)
        assert mine[0].mean_auc > 0.95


def test_cross_validation_equals_single_fits(spark):
    rows = stratified_folds(separable(spark, noise=1.5), "stay_id", "label", 3)
    cv = {r.fold: r for r in tuning.cross_validate(["logistic_regression"], rows, COLS).collect()}
    for i in range(3):
        m = models.fit_learner("logistic_regression", rows.where(F.col("fold") != i), COLS)
        s = models.score(m, rows.where(F.col("fold") == i), "logistic_regression")
        assert evaluate.roc_auc(s, ["model"]).first().auc == pytest.approx(cv[i].auc, abs=1e-9)
        assert evaluate.class_metrics(evaluate.confusion(s, ["model"])).first().f1 == pytest.approx(cv[i].f1)


def test_draws_are_seeded_and_different():
    for name, n in tuning.DRAWS.items():
        got = tuning.draw_settings(tuning.GRIDS[name], n)
        assert got == tuning.draw_settings(tuning.GRIDS[name], n) != tuning.draw_settings(tuning.GRIDS[name], n, seed=1)
        assert len({str(s) for s in got}) == n == {"random_forest": 20}.get(name, 15)
    assert len(tuning.draw_settings({"a": [1, 2], "b": [3]}, 15)) == 2


def test_tuner_discards_only_what_cannot_win(spark, monkeypatch):
    """AUCs by draw and fold are given; the full search has the same winner."""
    aucs = [[0.9, 0.9, 0.9], [0.2, 0.99, 0.99], [0.95, 0.85, 0.93], [0.6, 0.5, 0.99], [0.9, 0.95, 0.88], [0.95, 0.85, 0.93]]
    fits = []

    def fit(name, df, features, key, label, setting):
        out = set(range(3)) - {r.fold for r in df.select("fold").distinct().collect()}
        fits.append((setting["d"], out.pop() if out else None))
        return fits[-1]

    monkeypatch.setattr(tuning, "fit_learner", fit)
    monkeypatch.setattr(tuning, "_auc", lambda model, *rest: aucs[model[0]][model[1]])
    rows = stratified_folds(separable(spark, 30), "stay_id", "label", 3)
    model, table = tuning.tune("random_forest", rows, COLS, [{"d": d} for d in range(6)], parallelism=1)
    full = max(range(6), key=lambda d: (sum(aucs[d]) / 3, -d))
    assert model == (full, None) and [r[4] for r in table].index("best") == full
    assert [(r[2], r[4]) for r in table] == [(3, "complete"), (1, "discarded"), (3, "best" if full == 2 else "complete"), (1, "discarded"),
                                             (3, "best" if full == 4 else "complete"), (3, "complete")]


def test_gate_tunes_and_saves(spark, tmp_path):
    rows = stratified_folds(separable(spark), "stay_id", "label", 3)
    metrics = spark.createDataFrame([("random_forest", 0.91), ("xgboost_like", 0.7), ("lightgbm_like", 0.2), ("logistic_regression", 0.99)],
                                    "model string, auc double")
    assert {r.model for r in tuning.gate(metrics).collect()} == {"random_forest", "logistic_regression"}
    grids = {"random_forest": {"numTrees": [2, 4], "maxDepth": [1, 3]}, "xgboost_like": {"maxIter": [1]}}
    table = tuning.tune_gated(metrics, rows, COLS, str(tmp_path), grids=grids, draws={"random_forest": 3}).collect()
    assert len(table) == 3 and {r.model for r in table} == {"random_forest"}
    best = [r for r in table if r.status == "best"]
    assert len(best) == 1 and best[0].mean_auc > 0.9 and best[0].mean_auc == max(r.mean_auc for r in table if r.mean_auc is not None)
    (name, model), = load_models(spark, str(tmp_path)).items()
    assert name == "random_forest_tuned" and model.stages[-1].getNumTrees in (2, 4)
    assert tuning.tune_gated(metrics, rows, COLS, least=0.99).count() == 0


def test_bootstraps_are_balanced_and_poisson(spark):
    df = separable(spark, 3000)
    got = bootstrap.bootstrap_weights(df, 3, "stay_id").collect()
    for t in range(3):
        mine = [r for r in got if r.tree == t]
        drawn = {c: sum(r.n_drawn for r in mine if r.label == c) for c in (0, 1)}
        for r in mine:
            assert r.weight == pytest.approx(r.n_drawn * sum(drawn.values()) / (2 * drawn[r.label]))
        assert sum(r.weight for r in mine if r.label == 1) == pytest.approx(sum(r.weight for r in mine if r.label == 0))
        for k in (1, 2, 3):
            assert sum(r.n_drawn == k for r in mine) / 3000 == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.04)
    assert len({tuple(sorted(r.stay_id for r in got if r.tree == t)) for t in range(3)}) == 3


def test_balanced_forest_grows_deep_and_averages(spark):
    df = separable(spark, 400, noise=1.2)
    rows = VectorAssembler(inputCols=COLS, outputCol="features").transform(df)
    trees = bootstrap.fit_balanced_forest(rows, 6, "stay_id", minInstancesPerNode=1)
    assert len(trees) == 6 and max(t.depth for t in trees) > 10
    scored = bootstrap.forest_score(trees, rows).select("stay_id", "label", "score", "features").collect()
    for r in scored[:20]:
        assert r.score == pytest.approx(np.mean([t.predictProbability(r.features)[1] for t in trees]))
    auc = evaluate.roc_auc(spark.createDataFrame([("f", r.label, r.score) for r in scored], "model string, label int, score double"), ["model"])
    assert auc.first().auc > 0.9
