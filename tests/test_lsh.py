"""Approximate neighbours against brute force, with 64 dimensions."""

import numpy as np
import pytest

from outcomekit.operators import balance
from outcomekit.operators.lsh import LshPlan, bucket_ratio, knn_lsh, meeting_chance, recall, suggest_plan
from outcomekit.operators.neighbours import knn


def table(spark, points, label=None):
    cols = [f"f{j}" for j in range(points.shape[1])]
    rows = [(i, int(label[i]) if label is not None else 0, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id long, label int, " + ", ".join(f"{c} double" for c in cols)), cols


def brute(points, k):
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return {i: sorted(range(len(points)), key=lambda j: (round(d[i, j], 9), j))[:k] for i in range(len(points))}, d


def clustered(rng, n, dims, groups=40):
    centres = rng.normal(size=(groups, dims)) * 4
    return centres[rng.integers(0, groups, n)] + rng.normal(size=(n, dims)) * 0.5


def test_lsh_recall_at_64_dimensions(spark):
    rng = np.random.default_rng(11)
    points = clustered(rng, 800, 64)
    points[700:] = points[5]                        # one vector of a hundred rows
    df, cols = table(spark, points)
    plan = suggest_plan(df, df, "id", "id", cols, 5, target=0.95, plan=LshPlan(tables=6, width=3), exclude_self=True)
    found = knn_lsh(df, df, "id", "id", cols, 5, plan, exclude_self=True).cache()
    want, d = brute(points, 5)
    got = {}
    for r in found.collect():
        got.setdefault(r.id, {})[r.nn_id] = r.dist
        assert r.dist == pytest.approx(d[r.id, r.nn_id], abs=1e-9) and r.nn_id != r.id
    hits = sum(len(set(want[i]) & set(got.get(i, ()))) for i in want)
    assert hits >= 0.9 * 5 * len(want)
    exact = knn(df, df, "id", "id", cols, 5, exclude_self=True)
    assert {(r.id, r.nn_id) for r in exact.collect()} == {(i, j) for i, js in want.items() for j in js}
    row = recall(found, exact, "id").first()
    assert row.wanted == 4000 and row.hits == hits and row.recall == pytest.approx(hits / 4000)


def test_probes_and_tables_find_more(spark):
    rng = np.random.default_rng(12)
    df, cols = table(spark, clustered(rng, 400, 64, groups=10))
    exact = knn(df, df, "id", "id", cols, 5, exclude_self=True).cache()
    share = lambda plan: recall(knn_lsh(df, df, "id", "id", cols, 5, plan, exclude_self=True), exact, "id").first().recall
    plain = share(LshPlan(tables=2, width=3, bucket_length=6.0))
    assert plain < share(LshPlan(tables=2, width=3, bucket_length=6.0, probes=1)) <= share(LshPlan(tables=2, width=3, bucket_length=6.0, probes=3))
    assert plain < share(LshPlan(tables=6, width=3, bucket_length=6.0))
    assert share(LshPlan(tables=1, width=1, bucket_length=1e6, probes=1)) == 1.0


def test_meeting_chance_matches_projections():
    rng = np.random.default_rng(13)
    for ratio in (0.5, 1.0, 3.0):
        gap, start = rng.normal(size=200_000), rng.random(200_000) * ratio
        same = np.floor((start + gap) / ratio) == np.floor(start / ratio)
        assert meeting_chance(ratio) == pytest.approx(same.mean(), abs=0.005)
    ratio = bucket_ratio(0.9, 4, 3)
    assert 1 - (1 - meeting_chance(ratio) ** 3) ** 4 == pytest.approx(0.9, abs=1e-6)


def test_smote_with_lsh_makes_all_rows(spark):
    rng = np.random.default_rng(14)
    points = np.concatenate([rng.normal(size=(300, 8)), clustered(rng, 40, 8, 4), [[1e6] * 8]])      # one row without a neighbour near it
    df, cols = table(spark, points, np.arange(341) >= 300)
    out, nn = balance.smote(df, cols, "id", ratio=1.0, k=3, plan=LshPlan(tables=4, width=2, bucket_length=2.0))
    rows = out.where("is_synthetic").collect()
    assert len(rows) == 300 - 41 and out.count() == 341 + len(rows)
    near = {}
    for r in nn.collect():
        near.setdefault(r.id, []).append(r.nn_id)
    for r in rows:
        ends = [points[j] for j in near.get(r.id, [r.id])]
        p, s = np.array([r[c] for c in cols]), points[r.id]
        assert any(np.linalg.norm(np.cross(*(np.stack([(p - s)[:2], (e - s)[:2]])))) < 1e-6 for e in ends)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_exact_search_of_few_rows(spark, n):
    """Fewer reference rows than neighbours wanted: all of them, at a finite radius."""
    points = np.array([[0.0, 0.0], [5.0, 1.0], [900.0, 2.0]])[:n]
    ref, cols = table(spark, points.reshape(n, 2))
    query, _ = table(spark, np.array([[1.0, 1.0], [-4e3, 7.0], [1.0, 1.0]]))
    got = [(r.id, r.nn_id) for r in knn(query, ref, "id", "id", cols, 5).collect()]
    assert sorted(got) == [(q, i) for q in range(3) for i in range(n)]
