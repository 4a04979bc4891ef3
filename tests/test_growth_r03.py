"""What a query holds or repeats as its input grows: read off the plans."""

import datetime as dt
import math

from pyspark.sql import functions as F

from outcomekit.functions.quantiles import exact_quantiles
from outcomekit.operators import bootstrap, classify, evaluate
from outcomekit.sources.cohort import build_cohort


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark, path):
    when = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, 5.0, "A"), (2, -3.0, "B")], "c_custkey long, c_acctbal double, c_mktsegment string") \
        .write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame([(10, 1, when, "1-URGENT", 7.0), (11, 2, when, "5-LOW", 8.0), (12, None, when, "5-LOW", 9.0),
                           (13, 77, when, None, 1.0), (10, 1, when, "5-LOW", 6.0)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string, o_totalprice double") \
        .write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(10, 2.0, 20.0, 0.1, "A"), (10, 4.0, 30.0, 0.0, "N"), (12, 1.0, 5.0, 0.0, "R")],
                          "l_orderkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string") \
        .write.parquet(f"{path}/lineitem.parquet")


def test_customer_stays_off_the_driver(spark, tmp_path):
    _tables(spark, tmp_path)
    c = build_cohort(spark, str(tmp_path))
    got = sorted((r.stay_id, r.total, r.balance, r.segment, r.qty_range) for r in c.collect())
    assert got == [(10, 6.0, 5.0, "A", 2.0), (10, 7.0, 5.0, "A", 2.0), (11, 8.0, -3.0, "B", None),
                   (12, 9.0, None, None, 0.0), (13, 1.0, None, None, None)]
    customer = [x for x in _plan(c).splitlines() if "Join" in x and "c_custkey" in x]
    assert customer and all("SortMergeJoin" in x for x in customer)


def test_closed_form_fit_reads_each_row_once(spark):
    df = spark.createDataFrame([(0, 1.0, None), (0, 3.0, None), (1, 5.0, 2.0), (1, 5.0, 4.0), (None, 9.0, 1.0)],
                               "label int, a double, `b.c` double")
    nb = classify.fit_gaussian_nb(df, ["a", "b.c"])
    assert "Expand" not in _plan(nb)
    got = {(r.label, r.feature): (r.mu, r.var, r.prior) for r in nb.collect()}
    eps = 1e-9 * (sum(x * x for x in (1, 3, 5, 5, 9)) / 5 - 4.6 ** 2)
    assert set(got) == {(0, "a"), (0, "b.c"), (1, "a"), (1, "b.c")} and got[0, "b.c"][:2] == (None, None)
    assert got[0, "a"][0] == 2.0 and math.isclose(got[0, "a"][1], 1.0 + eps, rel_tol=1e-12)
    ce = classify.fit_centroids(df, ["a", "b.c"])
    assert "Expand" not in _plan(ce) and ce.count() == 6


def test_features_beyond_one_pass(spark):
    names = [f"x{i}" for i in range(classify.PER_PASS + 1)]
    df = spark.range(4).select((F.col("id") % 2).cast("int").alias("label"), *[(F.col("id") * (i + 1.0)).alias(n) for i, n in enumerate(names)])
    got = {(r.label, r.feature): r.mu for r in classify.fit_centroids(df, names).collect()}
    assert len(got) == 2 * len(names) and got[1, names[-1]] == 2.0 * len(names) and got[0, "x0"] == 1.0


def test_draws_hash_a_row_once_a_use(spark):
    df = spark.range(50).select(F.col("id").alias("stay_id"), (F.col("id") % 2).cast("int").alias("label"))
    drawn = df.withColumn("n", bootstrap.draws("stay_id", 3)).where("n > 0")
    assert drawn._jdf.queryExecution().optimizedPlan().toString().count("md5(") <= 2
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("stay_id"), F.lit(3), F.lit("boot42"))), 1, 8), 16, 10).cast("bigint") / 2.0 ** 32
    for r in df.select(bootstrap.draws("stay_id", 3).alias("n"), u.alias("u")).collect():
        assert r.n == sum(r.u >= p for p in bootstrap.POISSON)


def test_counts_of_values_and_scores_are_kept(spark):
    df = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.2), ("m", 1, 0.2), ("m", 0, 0.1)], "model string, label int, score double")
    auc = evaluate.roc_auc(df, ["model"])
    assert "InMemoryTableScan" in _plan(auc) and auc.first().auc == 0.875
    assert "InMemoryTableScan" in _plan(evaluate.roc_corners(df, ["model"]))
    q = exact_quantiles(df, ["model"], "score", [0.5])
    assert "InMemoryTableScan" in _plan(q) and math.isclose(q.first().quantile, 0.2) and q.first().n == 4
