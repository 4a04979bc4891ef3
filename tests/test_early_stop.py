"""Early stopping of boosted trees and of the network."""

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from outcomekit.operators import evaluate
from outcomekit.plans import early_stop, models


def blobs(spark, n=600, noise=0.0, seed=2):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    x = rng.normal(size=(n, 2)) + np.where(y == 1, 3.0, -3.0)[:, None]
    flip = rng.random(n) < noise
    return spark.createDataFrame(pd.DataFrame({"stay_id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "label": np.where(flip, 1 - y, y)})) \
        .repartition(3).cache()


def test_network_stops_and_the_best_weights_stay(spark, tmp_path):
    rows = blobs(spark)
    got = early_stop.fit_network(rows, ["a", "b"], hidden=(6,), leg=5, patience=2)
    assert got.stopped and got.steps <= got.tried < 500
    assert got.tried == 5 * len(got.history) and max(got.history) > 0.98
    assert got.history[got.steps // 5 - 1] >= max(got.history) - 1e-4
    held = rows.where(early_stop.held_out(rows, "stay_id", 0.1))
    assert 30 < held.count() < 100
    got.model.write().overwrite().save(str(tmp_path / "m"))
    scored = models.score(PipelineModel.load(str(tmp_path / "m")), held, "net")
    right = scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert right == got.history[got.steps // 5 - 1]


def test_network_without_validation_rows_runs_to_the_limit(spark):
    got = early_stop.fit_network(blobs(spark, 60), ["a", "b"], hidden=(3,), share=0.0, max_iter=6, leg=4)
    assert (got.tried, got.steps, got.stopped, got.history) == (6, 6, False, [None, None])


def test_boosting_stops_on_noise_only(spark):
    noisy = early_stop.fit_boosted(blobs(spark, 500, noise=0.3), ["a", "b"], max_iter=12, maxDepth=3)
    assert noisy.stopped and noisy.steps < 12
    auc = evaluate.roc_auc(models.score(noisy.model, blobs(spark, 300, seed=9), "gbt"), ["model"]).first().auc
    assert auc > 0.95
