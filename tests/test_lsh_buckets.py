"""Rows that meet in a bucket are compared in blocks: the plan holds no join of
them, and dealing a bucket to several groups changes nothing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomekit.operators import lsh
from outcomekit.plans import q_balance

COLS = ["f0", "f1", "f2"]


def _rows(spark):
    rng = np.random.default_rng(21)
    points = rng.integers(-15, 16, size=(240, 3)).astype(float)     # whole numbers: equal distances are ties
    points[200:220] = points[3]                          # copies
    return points, spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, f0 double, f1 double, f2 double")


def _got(df):
    return sorted((r.id, r.nn_id, round(r.dist, 9), r.nn_rank) for r in df.collect())


def _brute(points, k):
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    out = []
    for i in range(len(points)):
        near = sorted((round(d[i, j], 9), j) for j in range(len(points)) if j != i)[:k]
        out += [(i, j, x, n + 1) for n, (x, j) in enumerate(near)]
    return sorted(out)


def test_pairs_that_meet_make_no_rows(spark):
    _, df = _rows(spark)
    plan = lsh.knn_lsh(df, df, "id", "id", COLS, 3, lsh.LshPlan(tables=2, width=2, bucket_length=12.0), exclude_self=True)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "_nearest_in_bucket" in text or "MapInArrow" in text
    joins = [x for x in text.splitlines() if "Join" in x and "_key" in x]
    assert all("LeftOuter" in x for x in joins)          # the parts of large buckets only


def test_dealt_buckets_give_the_same_rows(spark, monkeypatch):
    points, df = _rows(spark)
    one = lsh.LshPlan(tables=1, width=1, bucket_length=1e6, probes=1)      # all rows meet
    assert _got(lsh.knn_lsh(df, df, "id", "id", COLS, 3, one, exclude_self=True)) == _brute(points, 3)
    some = lsh.LshPlan(tables=3, width=2, bucket_length=12.0, probes=1)
    whole = _got(lsh.knn_lsh(df, df, "id", "id", COLS, 3, some, exclude_self=True))
    monkeypatch.setattr(lsh, "MOST_ROWS", 7)
    monkeypatch.setattr(lsh, "QUERIES", 5)
    assert _got(lsh.knn_lsh(df, df, "id", "id", COLS, 3, some, exclude_self=True)) == whole
    assert _got(lsh.knn_lsh(df, df, "id", "id", COLS, 3, one, exclude_self=True)) == _brute(points, 3)


def test_neighbours_are_searched_once_for_recall_and_rows(spark):
    points, df = _rows(spark)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        calls.add(1)
        return x

    found = lsh.knn_lsh(df, df, "id", "id", COLS, 5, lsh.LshPlan(tables=1, width=1, bucket_length=1e6, probes=1), exclude_self=True)
    n = found.count()
    out = q_balance._with_recall(found.withColumn("dist", counted("dist")), df, df, "id", COLS, True)
    assert out.count() == n and out.where("recall = 1.0").count() == n
    assert {r.dist for r in out.collect()} and calls.value == pytest.approx(n)
