"""Hand-made edge cases (FIXTURES.md section 4)."""

import math

import pytest
from pyspark.sql import functions as F

from outcomekit.functions.dist import student_t_sf
from outcomekit.operators import evaluate, prep, profile, stats
from outcomekit.operators.balance import smote
from outcomekit.sources.tables import normalise_nulls


def test_text_times(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("bad",), (None,)], "t string")
    out = prep.add_time_parts(df.withColumn("ts", prep.parse_time_lenient(F.col("t"))), "ts").collect()
    assert out[0].ts is not None and out[1].ts is None and out[2].ts is None
    assert out[0].admit_dayofweek == 0 and out[0].admit_season == 1 and out[0].admit_hour == 10


def test_season_all_months(spark):
    df = spark.createDataFrame([(f"2023-{m:02d}-15 00:00:00",) for m in range(1, 13)], "t string")
    df = prep.add_time_parts(df.withColumn("ts", F.to_timestamp("t")), "ts")
    got = [r.admit_season for r in df.orderBy("admit_month").collect()]
    assert got == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 0.0), (3, 5.0), (4, None)], "id int, x double")
    got = [r.x for r in prep.clamp_columns(df, ["x"]).orderBy("id").collect()]
    assert got == [0.0, 0.0, 5.0, None]


def test_mode_tie_and_all_null(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)],
                               "s string, e string")
    fills = {r.feature: r.fill for r in prep.fit_mode(df, ["s", "e"]).collect()}
    assert fills == {"s": "a", "e": "Unknown"}


def test_duplicates_nan_null_zero(spark):
    df = spark.createDataFrame([(float("nan"),), (float("nan"),), (None,), (None,), (0.0,), (-0.0,)], "x double")
    r = profile.duplicate_rows(normalise_nulls(df)).first()
    assert r.n_duplicates == 4 and r.n_duplicate_groups == 2


def test_missing_cut_is_strict(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 2.0)], "a double, b double")
    fit = {r.column_name: r.keep for r in prep.fit_missingness(df, ["a", "b"], 0.5).collect()}
    assert fit == {"a": False, "b": True}


def test_constant_feature(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (0, 1.0, 2.0), (1, 1.0, 3.0), (1, 1.0, 5.0)],
                               "label int, c double, x double")
    m = stats.feature_moments(stats.long_form(df, ["c", "x"], "label"))
    corr = {r.feature for r in stats.feature_label_corr(m).collect()}
    assert "c" not in corr and "x" in corr
    d = {r.feature: r.cohens_d for r in stats.cohens_d(m).collect()}
    assert d["c"] == 0.0


def test_tiny_group(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (0, 3.0), (1, 4.0)], "label int, x double")
    long = stats.long_form(df, ["x"], "label")
    m = stats.feature_moments(long)
    assert m.first().var_1 is None
    stats.gated_tests(m, long).collect()  # no failure
    t = {r.feature: r for r in stats.t_tests(m).collect()}
    assert t["x"].t_pooled is None      # (n1 - 1) * NULL variance: t NULL, as scipy gives NaN
    assert t["x"].t_welch is None       # one-row group: variance NULL, no failure


def test_t_tail():
    assert abs(float(student_t_sf(2.0, 10.0)) - 0.07338803477) < 1e-10


def _preds(spark, rows):
    return spark.createDataFrame([("m",) + r for r in rows], "model string, label int, score double, prediction int")


def test_score_ties(spark):
    p = _preds(spark, [(1, 0.5, 0), (0, 0.5, 0), (0, 0.5, 0), (1, 0.5, 0)])
    assert evaluate.roc_auc(p, ["model"]).first().auc == 0.5
    ap = evaluate.average_precision(p, ["model"]).first()
    assert ap.average_precision == pytest.approx(0.5) and ap.baseline == pytest.approx(0.5)


def test_no_predicted_positives(spark):
    p = _preds(spark, [(1, 0.1, 0), (0, 0.2, 0), (1, 0.3, 0)])
    r = evaluate.class_metrics(evaluate.confusion(p, ["model"])).first()
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)


def test_perfect_split(spark):
    p = _preds(spark, [(1, 1.0, 1), (0, 0.0, 0), (1, 1.0, 1), (0, 0.0, 0)])
    assert evaluate.roc_auc(p, ["model"]).first().auc == 1.0
    assert evaluate.average_precision(p, ["model"]).first().average_precision == 1.0
    y = evaluate.youden_threshold(evaluate.roc_curve(p, ["model"]), ["model"]).first()
    assert y.threshold == 1.0


def test_width_bucket_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(101)], "v double")
    h = {r.bin: r.n for r in stats.histogram(df, "v", 50).collect()}
    assert max(h) == 50 and sum(h.values()) == 101 and h[50] == 3


def test_smote_adaptive_k(spark):
    rows = [(i, 1, float(i), float(i % 2)) for i in range(4)] + [(10 + i, 0, float(i), 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, label int, a double, b double")
    out, nn = smote(df, ["a", "b"], "id", "label", ratio=1.0, k=5, adaptive_k=True)
    assert nn.agg(F.max("nn_rank")).first()[0] == 3
    assert out.where("label = 1").count() == 20


def test_schema_profiles(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id long, s string, x double") \
        .withColumn("t", F.current_timestamp())
    kinds = {r.kind: r.n_columns for r in profile.kind_counts(df).collect()}
    assert kinds == {"numeric": 2, "categorical": 1, "datetime": 1, "other": 0}
    types = {r.dtype: r.n_columns for r in profile.dtype_histogram(df).collect()}
    assert types == {"bigint": 1, "string": 1, "double": 1, "timestamp": 1}
    assert profile.column_names(df, 2) == ["id", "s"]
    assert prep.feature_columns(df.withColumnRenamed("id", "stay_id")) == ["x"]


def test_imputation_leaves_present_values(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=30))
    def check(vals):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
        for strategy in ("median", "mean", "zero"):
            fills = prep.fit_impute(df, ["x"], strategy)
            out = {r.id: r.x for r in prep.apply_impute(df, fills).collect()}
            present = [v for v in vals if v is not None]
            for i, v in enumerate(vals):
                if v is not None:
                    assert out[i] == v
                elif present or strategy == "zero":
                    assert out[i] is not None
                else:
                    assert out[i] is None  # all-null column: fill is NULL, stays NULL
    check()
