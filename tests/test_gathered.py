"""Learners read their training rows from as few partitions as the cores can share."""

import numpy as np
from pyspark.sql import functions as F

from outcomekit.operators import kernel, prep
from outcomekit.plans import models


def test_training_rows_are_gathered(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(1000).repartition(5 * cores)
    assert prep.gathered(df).rdd.getNumPartitions() == 5 * cores           # few rows stay as they lie
    monkeypatch.setattr(prep, "ROWS_A_TASK", 900)
    few = prep.gathered(df)
    assert few.rdd.getNumPartitions() == cores and few.count() == 1000
    assert prep.gathered(spark.range(1000, numPartitions=1)).rdd.getNumPartitions() == 1
    monkeypatch.setattr(prep, "ROWS_A_TASK", 1000 // (2 * cores))          # more rows than the cores should take at once
    assert prep.gathered(df).rdd.getNumPartitions() >= 2 * cores


def test_learner_fits_on_gathered_rows(spark, monkeypatch):
    seen = []
    real = models.gathered
    monkeypatch.setattr(prep, "ROWS_A_TASK", 100)
    monkeypatch.setattr(models, "gathered", lambda rows: seen.append(real(rows)) or seen[-1])
    rows = spark.range(200).select(F.col("id").alias("stay_id"), (F.col("id") % 2).cast("int").alias("label"),
                                   (F.col("id") % 7 + F.col("id") % 2).cast("double").alias("x")).repartition(40)
    for name, small in (("lightgbm_like", {"maxIter": 1, "maxDepth": 2}), ("neural_network", {"maxIter": 2, "hidden": [2]})):
        models.fit_learner(name, rows, ["x"], overrides=small)
        assert seen.pop().rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_cosines_keep_null_vectors(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import StructField, StructType
    df = spark.createDataFrame([(Vectors.dense(1.0, 2.0),), (None,), (Vectors.dense(0.0, 0.0),)], StructType([StructField("features", VectorUDT())]))
    got = [r[0] for r in kernel.RandomFourierFeatures("features", "f", 2, 8).transform(df).select("f").collect()]
    w, b = kernel.frequencies(2, 8, 0.5)
    assert got[1] is None and np.allclose(got[0].toArray(), 0.5 * np.cos(w @ [1.0, 2.0] + b)) and np.allclose(got[2].toArray(), 0.5 * np.cos(b))
