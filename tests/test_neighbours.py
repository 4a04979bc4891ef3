import numpy as np
import pytest

from outcomekit.operators.neighbours import knn


def _brute(q, r, k, exclude_self):
    out = {}
    for i, x in q:
        cand = []
        for j, y in r:
            if exclude_self and i == j:
                continue
            cand.append((float(np.sqrt(((np.array(x) - np.array(y)) ** 2).sum())), j))
        cand.sort()
        out[i] = [j for _, j in cand[:k]]
    return out


@pytest.mark.parametrize("exclude_self,dup", [(True, False), (False, False), (True, True)])
def test_knn_matches_brute_force(spark, exclude_self, dup):
    rng = np.random.default_rng(7)
    n, d, k = 300, 4, 5
    pts = rng.normal(size=(n, d)) * np.array([100.0, 10.0, 1.0, 0.1])
    if dup:
        pts[:60] = pts[0]  # a heavily repeated point
    rows = [(i, *map(float, p)) for i, p in enumerate(pts)]
    cols = [f"f{j}" for j in range(d)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in cols))
    got = knn(df, df, "id", "id", cols, k, exclude_self=exclude_self, rows_per_cell=16).collect()
    res = {}
    for r in sorted(got, key=lambda r: (r.id, r.nn_rank)):
        res.setdefault(r.id, []).append(r.nn_id)
    want = _brute([(i, p) for i, p in enumerate(pts)], [(i, p) for i, p in enumerate(pts)], k, exclude_self)
    assert res == want


def _ranked(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.id, r.nn_rank)):
        out.setdefault(r.id, []).append(r.nn_id)
    return out


def test_knn_with_nulls_and_values_that_are_not_finite(spark):
    rng = np.random.default_rng(3)
    pts = [(i, *map(float, p)) for i, p in enumerate(rng.integers(0, 4, size=(120, 3)))]      # many equal distances
    odd = [(200, None, 1.0, 1.0), (201, 1.0, None, None), (202, float("nan"), 1.0, 1.0), (203, float("inf"), 0.0, 0.0)]
    schema = "id long, a double, b double, c double"
    got = _ranked(knn(spark.createDataFrame(pts[:40] + odd, schema), spark.createDataFrame(odd + pts, schema), "id", "id",
                      ["a", "b", "c"], 4, rows_per_cell=16).collect())
    whole = [(i, p) for i, *p in pts]
    assert {i: got[i] for i in range(40)} == _brute(whole[:40], whole + [(203, [float("inf"), 0.0, 0.0])], 4, False)
    # no distance is known: none, or by id alone
    assert 200 not in got and 201 not in got and got[202] == [0, 1, 2, 3] and got[203][:3] == [0, 1, 2]
    few = spark.createDataFrame(pts[:2] + odd, schema)
    assert _ranked(knn(few.where("id < 2"), few, "id", "id", ["a", "b", "c"], 4).collect())[0] == \
        sorted([0, 1], key=lambda i: (np.linalg.norm(np.subtract(pts[i][1:], pts[0][1:])), i)) + [203, 202]


def test_pairs_follow_the_rows_where_many_directions_vary():
    """Rows a query meets, in data that varies alike in four directions: with 8 times the rows less than twice as many."""
    from outcomekit.operators import neighbours as nb
    met = []
    for n in (8_000, 64_000):
        x = np.random.default_rng(5).normal(size=(n, 4))
        leaves = n // 256
        tree = nb._grow(x[:leaves * nb.SAMPLED], np.eye(4), leaves, 6)
        at = tree.leaf(x)
        boxes = nb._boxes(tree, [{"_leaf": leaf, "_n": int((at == leaf).sum()), "_low": x[at == leaf].min(axis=0),
                                  "_high": x[at == leaf].max(axis=0)} for leaf in np.unique(at)])
        assert boxes.rows[0] == n and len(boxes.of_leaves()) >= leaves
        some = np.arange(0, n, n // 200)
        reach = np.array([np.sort(np.linalg.norm(x[at == at[i]] - x[i], axis=1))[5] for i in some])
        who, cell = boxes.near(x[some], reach)
        for w, i in enumerate(some[:20]):            # no row within reach lies outside the cells
            near = np.flatnonzero(np.linalg.norm(x - x[i], axis=1) <= reach[w])
            assert set(at[near]) <= set(cell[who == w])
        met.append(boxes.rows[cell].sum() / len(some))
    assert met[1] < 2 * met[0]
