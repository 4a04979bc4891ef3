"""The network's distributed steps: gradient, descent, MLlib's model, the whole budget."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from outcomekit.operators import perceptron, prep
from outcomekit.plans import early_stop, models


def ring(spark, n=600):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 2))
    return spark.createDataFrame([(i, float(a), float(b), int(a * a + b * b > 1.4)) for i, (a, b) in enumerate(x)],
                                 "stay_id long, a double, b double, label int").repartition(3).cache()


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    layers, x, y = [3, 4, 3, 2], rng.normal(size=(9, 3)), rng.integers(0, 2, 9)
    w = rng.normal(size=3 * 4 + 4 + 4 * 3 + 3 + 3 * 2 + 2)
    loss, grad = perceptron.loss_and_gradient(w, layers, x, y)
    for i in range(len(w)):
        e = np.eye(len(w))[i] * 1e-6
        up, down = (perceptron.loss_and_gradient(v, layers, x, y)[0] for v in (w + e, w - e))
        assert grad[i] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_loss_is_that_of_mllib_and_steps_lower_it(spark, monkeypatch):
    monkeypatch.setattr(perceptron, "BLOCK", 128)
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(ring(spark)).coalesce(1)
    start = MultilayerPerceptronClassifier(labelCol="label", layers=[2, 5, 2], seed=1, maxIter=0, blockSize=600).fit(rows)
    data = perceptron.blocks(rows)
    assert data.count() == 5
    loss = lambda m: perceptron._summed(data, [2, 5, 2], m.weights.toArray())[0]               # noqa: E731
    assert loss(start) == pytest.approx(start.summary().objectiveHistory[0], rel=1e-9)
    got = [loss(perceptron.fit_perceptron(rows, [2, 5, 2], n, 0.0, 1)) for n in (0, 5, 60)]
    assert got[0] == pytest.approx(loss(start)) and got[0] > got[1] > got[2]
    theirs = MultilayerPerceptronClassifier(labelCol="label", layers=[2, 5, 2], seed=1, maxIter=60, tol=0.0, blockSize=600).fit(rows)
    assert got[2] < max(0.1, 2 * loss(theirs))


def test_descent_finds_the_bottom_and_keeps_its_budget():
    scale = np.array([1.0, 30.0, 400.0])
    value = lambda w: (float((scale * (w - 1) ** 2).sum()), 2 * scale * (w - 1))              # noqa: E731
    w, history = perceptron.minimise(value, np.zeros(3), 100, 0.0)
    assert np.allclose(w, 1, atol=1e-5) and history == sorted(history, reverse=True)
    assert len(perceptron.minimise(value, np.zeros(3), 3, 0.0)[1]) == 4


def test_learner_has_the_whole_budget_and_survives_saving(spark, monkeypatch, tmp_path):
    assert models.LEARNERS["neural_network"][1].params["maxIter"] == 500
    asked, real = [], perceptron.minimise
    monkeypatch.setattr(perceptron, "minimise", lambda value, w, max_iter, tol: asked.append(max_iter) or real(value, w, min(max_iter, 40), tol))
    rows = ring(spark)
    m = models.fit_learner("neural_network", rows, ["a", "b"], overrides={"hidden": [8], "balance": "none"})
    assert asked == [500]
    m.write().overwrite().save(str(tmp_path / "m"))
    scored = models.score(PipelineModel.load(str(tmp_path / "m")), rows, "net")
    assert scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.9


def test_early_stopping_of_many_rows_takes_the_same_steps(spark, monkeypatch):
    rows, seen, real = ring(spark, 900), [], perceptron.fit_perceptron
    monkeypatch.setattr(perceptron, "fit_perceptron", lambda *a, **kw: seen.append(kw["data"]) or real(*a, **kw))
    few = early_stop.fit_network(rows, ["a", "b"], hidden=(8,), max_iter=20)
    assert not seen and few.tried == 20
    monkeypatch.setattr(prep, "ROWS_A_TASK", 300)
    many = early_stop.fit_network(rows, ["a", "b"], hidden=(8,), max_iter=60)
    assert len(seen) == len(many.history) and len({id(d) for d in seen}) == 1 and max(many.history) > 0.85
