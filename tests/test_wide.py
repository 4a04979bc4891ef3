"""Wide-table moments and the masked Gramian against numpy."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomekit.operators import stats
from outcomekit.operators.wide import group_moments, pairwise_corr, wide_moments


def holes(rng, n, d, share=0.2):
    x = rng.normal(size=(n, d)) + rng.normal(size=(n, 1)) * rng.random(d) + 1e6 * rng.random(d)
    x[rng.random((n, d)) < share] = np.nan
    return x


def frame(spark, x, label, parts=3):
    import pandas as pd
    cols = [f"f{j}" for j in range(x.shape[1])]
    pdf = pd.DataFrame(x, columns=cols)
    pdf["label"] = label
    return spark.createDataFrame(pdf).repartition(parts), cols


def complete_r(a, b):
    both = ~np.isnan(a) & ~np.isnan(b)
    if both.sum() < 2 or np.ptp(a[both]) == 0 or np.ptp(b[both]) == 0:
        return int(both.sum()), None
    return int(both.sum()), float(np.corrcoef(a[both], b[both])[0, 1])


def test_masked_gramian_equals_pairwise_complete(spark):
    rng = np.random.default_rng(21)
    x = holes(rng, 400, 12)
    x[:, 3], x[:, 4], x[:, 5] = 7.5, np.nan, x[:, 6] * -2      # constant, empty, opposite
    df, cols = frame(spark, x, 0)
    got = {(r.i, r.j): r for r in pairwise_corr(df, cols).collect()}
    assert len(got) == 66
    for (i, j), r in got.items():
        n, want = complete_r(x[:, i], x[:, j])
        assert (r.feature_a, r.feature_b, r.n) == (cols[i], cols[j], n)
        assert r.r == (pytest.approx(want, abs=1e-7) if want is not None else None)
    assert pairwise_corr(df.limit(0), cols).count() == 0
    assert stats.strong_pairs(pairwise_corr(df, cols), 0.8, 5).collect()[0][:2] == ("f5", "f6")


def test_strong_pairs_come_in_matrix_order(spark):
    rng = np.random.default_rng(22)
    base = rng.normal(size=(300, 1))
    x = np.concatenate([base + rng.normal(size=(300, 1)) * s for s in (0.3, 0.01, 0.2, 0.001)], axis=1)
    df, cols = frame(spark, x, 0)
    got = [(r.feature_a, r.feature_b) for r in stats.strong_pairs(pairwise_corr(df, cols), 0.8, 5).collect()]
    assert got == [("f0", "f1"), ("f0", "f2"), ("f0", "f3"), ("f1", "f2"), ("f1", "f3")]


def test_wide_moments_match_numpy(spark):
    rng = np.random.default_rng(23)
    x, label = holes(rng, 500, 9), rng.integers(0, 2, 500)
    x[:, 2] = np.nan
    x[label == 1, 3] = np.nan
    df, cols = frame(spark, x, label)
    for r in wide_moments(df, cols, "label").collect():
        v = x[label == r.cls, cols.index(r.feature)]
        v, missing = v[~np.isnan(v)], int(np.isnan(v).sum())
        assert (r.n, r.missing) == (len(v), missing)
        if len(v):
            assert (r.min, r.max) == (v.min(), v.max()) and r.mean == pytest.approx(v.mean(), rel=1e-12)
            assert r.m2 == pytest.approx(((v - v.mean()) ** 2).sum(), rel=1e-9)
        else:
            assert (r.mean, r.m2, r.min, r.max) == (None,) * 4
    assert wide_moments(df.limit(0), cols, "label").count() == 0


def test_group_moments_equal_the_long_form(spark):
    rng = np.random.default_rng(24)
    x, label = rng.normal(size=(300, 6)) * 10 + 50, rng.integers(0, 2, 300)
    df, cols = frame(spark, x, label)
    want = {r.feature: r.asDict() for r in stats.feature_moments(stats.long_form(df, cols, "label")).collect()}
    for r in group_moments(df, cols).collect():
        for name, value in r.asDict().items():
            assert want[r.feature][name] == (pytest.approx(value, rel=1e-9) if isinstance(value, float) else value), name


def test_1700_columns(spark):
    """Figures of this size are in the README."""
    rng = np.random.default_rng(25)
    x, label = holes(rng, 600, 1700, 0.1), rng.integers(0, 2, 600)
    df, cols = frame(spark, x, label, 4)
    t0 = time.time()
    got = {r.feature: r for r in group_moments(df, cols).collect()}
    t1 = time.time()
    pairs = pairwise_corr(df, cols).agg(F.count("*").alias("n"), F.count("r").alias("r")).first()
    t2 = time.time()
    print(f"moments {t1 - t0:.1f} s, correlation {t2 - t1:.1f} s")
    assert len(got) == 1700 and pairs.n == pairs.r == 1700 * 1699 // 2
    for j in (0, 800, 1699):
        v = x[:, j][~np.isnan(x[:, j])]
        assert got[f"f{j}"].std == pytest.approx(v.std(ddof=1), rel=1e-9)
    assert t1 - t0 < 120 and t2 - t1 < 180
