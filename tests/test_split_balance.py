import math

import pytest
from pyspark.sql import functions as F

from outcomekit.operators import balance, split
from outcomekit.plans.prepared import prepare
from conftest import SF_SMOKE


def test_group_split_disjoint_and_complete(spark):
    df = spark.createDataFrame([(i, i % 37) for i in range(2000)], "stay long, subject long")
    s = split.group_split(df, "subject")
    per = s.groupBy("subject").agg(F.count_distinct("split").alias("k"))
    assert per.where("k > 1").count() == 0
    assert s.count() == 2000


def test_split_exact_size(spark):
    df = spark.createDataFrame([(i, i % 101) for i in range(3000)], "stay long, subject long")
    s = split.split_exact(df, "subject", 0.2)
    n_test = s.where("split = 'test'").select("subject").distinct().count()
    assert n_test == math.ceil(0.2 * 101)


def test_split_exact_gives_rows_without_subject_one_side(spark):
    df = spark.createDataFrame([(i, i % 10 or None) for i in range(200)], "stay long, subject long")
    s = split.split_exact(df, "subject", 0.3)
    assert s.count() == 200 and s.where("split is null").count() == 0
    assert s.where("subject is null").select("split").distinct().count() == 1
    per = s.groupBy("subject").agg(F.min("split").alias("side")).groupBy("side").count()
    assert {r.side: r["count"] for r in per.collect()} == {"test": 3, "train": 7}


def test_failed_scoring_is_a_row_of_the_error_table(spark):
    from outcomekit.plans.models import fit_and_score
    train = spark.createDataFrame([(i, int(i % 3 == 0), float(i % 7)) for i in range(60)], "key long, label int, x double")
    bad = train.withColumn("x", F.when(F.col("key") >= 0, F.raise_error(F.lit("no such value")).cast("double")))
    preds, errors = fit_and_score(["logistic_regression"], train, bad, ["x"], key="key")
    assert preds.columns == ["model", "key", "label", "score", "prediction"] and preds.count() == 0
    (row,) = errors.collect()
    assert row.model == "logistic_regression" and "no such value" in row.error
    good, none = fit_and_score(["logistic_regression"], train, train, ["x"], key="key")
    assert good.count() == 60 and none.count() == 0


def test_stratified_folds_balance(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1200)], "id long, label int")
    f = split.stratified_folds(df, "id", "label", 3)
    counts = {(r.label, r.fold): r["count"] for r in f.groupBy("label", "fold").count().collect()}
    assert counts[(1, 0)] == counts[(1, 1)] == counts[(1, 2)] == 100
    assert counts[(0, 0)] == counts[(0, 1)] == counts[(0, 2)] == 300


def test_smote_points_between_seed_and_neighbour(spark):
    p = prepare(spark, SF_SMOKE)
    out, nn = balance.smote(p.train, p.features, "stay_id", "label", ratio=0.3, k=5)
    counts = balance.class_counts(p.train, "label")
    syn = out.where("is_synthetic")
    assert syn.count() == balance.smote_target(counts[1], counts[0], 0.3)
    # originals are untouched
    assert out.where("NOT is_synthetic").count() == p.train.count()
    f = p.features[0]
    seeds = p.train.select("stay_id", F.col(f).alias("x"))
    chk = syn.select("stay_id", "sample_idx", F.col(f).alias("s")).join(seeds, "stay_id")
    nbr_vals = nn.join(p.train.select(F.col("stay_id").alias("nn_id"), F.col(f).alias("y")), "nn_id") \
        .groupBy("stay_id").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    bad = chk.join(nbr_vals, "stay_id").where(
        (F.col("s") < F.least("x", "lo") - 1e-9) | (F.col("s") > F.greatest("x", "hi") + 1e-9))
    assert bad.count() == 0


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 30 + [(1,)] * 10, "label int")
    w = {r.label: r.weight for r in balance.balanced_weights(df).collect()}
    assert w[0] == pytest.approx(40 / (2 * 30)) and w[1] == pytest.approx(40 / (2 * 10))
