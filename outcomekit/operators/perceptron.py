"""Multilayer perceptron by full-batch L-BFGS, its gradient summed by Spark.

The model, its first weights and its loss are those of
``MultilayerPerceptronClassifier`` (sigmoid layers, softmax, mean
cross-entropy).  Training rows lie in blocks of a thousand; a step sends
the weights to the tasks, each task takes the gradient of its blocks by matrix
products, and one row a partition comes back.  MLlib's own steps spend most of
their time in small products without a native BLAS.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.config import SEED

BLOCK = 1024                 # rows of one block
CORRECTIONS = 10             # steps that L-BFGS remembers


def blocks(rows: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """(``x``, ``y``): features and labels of up to ``BLOCK`` rows as bytes, cached."""
    def pack(batches):
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.slice(lo, BLOCK)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                y = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], ["x", "y"])
    flat = rows.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("long").alias("y"))
    return flat.mapInArrow(pack, "x binary, y binary").persist()


def _layers(w: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(matrix of outputs x inputs, offsets) of each layer, in the order of Spark's weights."""
    out, at = [], 0
    for n, m in zip(layers, layers[1:]):
        out.append((w[at:at + n * m].reshape(n, m).T, w[at + n * m:at + n * m + m]))
        at += n * m + m
    return out


def loss_and_gradient(w: np.ndarray, layers: list[int], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Sums over the rows of ``x``."""
    net, acts = _layers(w, layers), [x]
    with np.errstate(over="ignore"):
        for a, b in net[:-1]:
            acts.append(1.0 / (1.0 + np.exp(-(acts[-1] @ a.T + b))))
    a, b = net[-1]
    z = acts[-1] @ a.T + b
    z -= z.max(axis=1, keepdims=True)
    log = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    at = np.arange(len(y))
    delta, parts = np.exp(log), []
    delta[at, y] -= 1.0
    for i in range(len(net) - 1, -1, -1):
        parts.append(np.concatenate([(acts[i].T @ delta).ravel(), delta.sum(axis=0)]))
        if i:
            delta = (delta @ net[i][0]) * acts[i] * (1.0 - acts[i])
    return -float(log[at, y].sum()), np.concatenate(parts[::-1])


def _summed(data: DataFrame, layers: list[int], w: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean loss and gradient over all rows; one row a partition reaches the driver."""
    def part(batches):
        n, loss, grad = 0, 0.0, np.zeros(len(w))
        for b in batches:
            for x, y in zip(b.column(0), b.column(1)):
                y = np.frombuffer(y.as_py(), dtype=np.int64)
                some, more = loss_and_gradient(w, layers, np.frombuffer(x.as_py()).reshape(len(y), -1), y)
                n, loss, grad = n + len(y), loss + some, grad + more
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([loss]), pa.array([grad.tobytes()], pa.binary())], ["n", "loss", "grad"])
    got = data.mapInArrow(part, "n long, loss double, grad binary").collect()
    n = max(1, sum(r["n"] for r in got))
    return sum(r["loss"] for r in got) / n, sum((np.frombuffer(r["grad"]) for r in got), np.zeros(len(w))) / n


def _direction(g: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """L-BFGS: minus the gradient, times the inverse curvature seen in ``past`` (steps, changes of the gradient)."""
    q, back = -g, []
    for s, y in reversed(past):
        a = (s @ q) / (s @ y)
        q = q - a * y
        back.append(a)
    if past:
        s, y = past[-1]
        q = q * ((s @ y) / (y @ y))
    for (s, y), a in zip(past, reversed(back)):
        q = q + (a - (y @ q) / (s @ y)) * s
    return q


def _step(value, w: np.ndarray, f: float, g: np.ndarray, d: np.ndarray, t: float) -> tuple | None:
    """(weights, loss, gradient) at a step along ``d`` that meets the strong Wolfe conditions, or at the best one of 20 tried."""
    slope, low, high, best = g @ d, (0.0, f, g @ d), None, None
    for _ in range(20):
        at = w + t * d
        f1, g1 = value(at)
        s1 = g1 @ d
        if np.isfinite(f1) and f1 < f and (best is None or f1 < best[1]):
            best = (at, f1, g1)
        if not np.isfinite(f1) or f1 > f + 1e-4 * t * slope or f1 >= low[1] and low[0] > 0:
            high = t
        elif abs(s1) <= -0.9 * slope:
            return at, f1, g1
        elif s1 >= 0:
            high, low = (low[0], (t, f1, s1))
        else:
            low = (t, f1, s1)
        t = 2.0 * t if high is None else 0.5 * (low[0] + high)
    return best


def minimise(value, w: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, list[float]]:
    """Weights after up to ``max_iter`` L-BFGS steps and the loss before and
    after each; ends when ten steps lower the loss by less than ``tol`` of it."""
    f, g = value(w)
    past, history = [], [f]
    while len(history) <= max_iter and np.linalg.norm(g) > 1e-12:
        d = _direction(g, past)
        if g @ d >= 0:
            past, d = [], -g
        got = _step(value, w, f, g, d, 1.0 if past else 1.0 / np.linalg.norm(d))
        if got is None:
            if not past:
                break
            past = []                                     # once more along the gradient
            continue
        s, y = got[0] - w, got[2] - g
        if s @ y > 1e-10 * (y @ y):
            past = [*past, (s, y)][-CORRECTIONS:]
        w, f, g = got
        history.append(f)
        if len(history) > 10 and history[-11] - f <= tol * abs(f):
            break
    return w, history


def fit_perceptron(rows: DataFrame, layers: list[int], max_iter: int = 100, tol: float = 1e-6, seed: int = SEED,
                   initial: DenseVector | None = None, features: str = "features", label: str = "label",
                   data: DataFrame | None = None) -> MultilayerPerceptronClassificationModel:
    """The perceptron of ``rows``, as MLlib's model.  ``data`` are the rows' ``blocks``, if they are there already."""
    mlp = MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=layers, seed=seed, maxIter=0)
    one = rows.limit(1).persist()
    own = blocks(rows, features, label) if data is None else data
    try:
        # without a step MLlib returns the weights it would begin with, as a model
        start = (initial if initial is not None else mlp.fit(one).weights).toArray()
        w, _ = minimise(lambda at: _summed(own, layers, at), start, max_iter, tol)
        return mlp.setInitialWeights(DenseVector(w)).fit(one)
    finally:
        one.unpersist()
        if data is None:
            own.unpersist()
