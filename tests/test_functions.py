import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from outcomekit.functions.dist import student_t_sf
from outcomekit.functions.prefix import running_totals
from outcomekit.functions.quantiles import exact_quantiles


@pytest.mark.parametrize("rows_per_range", [500_000, 100])
def test_exact_quantiles_match_numpy(spark, rows_per_range):
    rng = np.random.default_rng(3)
    rows = [("a", float(x)) for x in rng.normal(size=2000)]
    rows += [("b", float(x)) for x in rng.integers(0, 5, size=1500)]      # heavy ties
    rows += [("c", 7.0)] * 900 + [("c", float(x)) for x in rng.normal(size=100)]  # a hot value
    rows += [("d", None), ("d", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(df, ["g"], "v", probs, rows_per_range=rows_per_range).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"]).dropna()
    for g, grp in pdf.groupby("g"):
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.percentile(grp.v, p * 100)), abs=1e-12)


def test_running_totals_many_ranges(spark):
    rng = np.random.default_rng(5)
    rows = [(int(g), float(s), int(c)) for g, s, c in zip(rng.integers(0, 3, 3000), rng.permutation(3000), rng.integers(0, 9, 3000))]
    df = spark.createDataFrame(rows, "g int, s double, c int")
    out = running_totals(df, "s", ["c"], by=["g"], descending=True, rows_per_range=100).toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "s", "c"]).sort_values(["g", "s"], ascending=[True, False])
    pdf["want"] = pdf.groupby("g")["c"].cumsum()
    m = out.merge(pdf, on=["g", "s", "c"])
    assert len(m) == 3000 and (m.cum_c == m.want).all()


@settings(max_examples=30, deadline=None)
@given(st.floats(min_value=-50, max_value=50), st.floats(min_value=1, max_value=5000))
def test_t_tail_symmetry_and_range(t, nu):
    p = float(student_t_sf(t, nu))
    assert 0.0 <= p <= 1.0
    assert p == pytest.approx(float(student_t_sf(-t, nu)), abs=1e-12)


def test_t_tail_known_values():
    # two-sided normal limit for large nu, and t = 0
    assert float(student_t_sf(1.959963984540054, 1e7)) == pytest.approx(0.05, abs=1e-6)
    assert float(student_t_sf(0.0, 5.0)) == pytest.approx(1.0)


def test_t_tail_at_large_degrees_of_freedom():
    for nu in (9e5, 1.1e6, 1e12, 1e13):
        assert float(student_t_sf(1.7, nu)) == pytest.approx(0.0891309, abs=1e-6)


def test_exact_quantiles_null_key_and_nan(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", float("nan")), ("a", 2.0), ("b", None)]
    got = exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", [0.5, 1.0]).collect()
    assert {(r.g, r.prob): (r.quantile, r.n) for r in got} == {
        (None, 0.5): (2.0, 2), (None, 1.0): (3.0, 2), ("a", 0.5): (2.0, 1), ("a", 1.0): (2.0, 1)}
