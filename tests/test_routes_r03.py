"""The exact search looks for the boxes of a few queries at once."""

import numpy as np

from outcomekit.operators import neighbours


def test_queries_routed_in_slices_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROUTED", 7)
    monkeypatch.setattr(neighbours, "SENT", 5)
    x = np.random.default_rng(4).normal(size=(400, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    got = neighbours.knn(df, df, "id", "id", ["a", "b", "c"], 3, exclude_self=True, rows_per_cell=20).collect()
    d = ((x[:, None] - x) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    want = {(i, r + 1): int(j) for i, row in enumerate(np.argsort(d, axis=1, kind="stable")[:, :3]) for r, j in enumerate(row)}
    assert {(r.id, r.nn_rank): r.nn_id for r in got} == want
