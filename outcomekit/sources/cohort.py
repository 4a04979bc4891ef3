"""The test cohort: one row per order, mapped onto stay-table roles.

stay_id <- o_orderkey, subject_id <- o_custkey, admit_time <- o_orderdate,
label <- (o_orderpriority = '1-URGENT'), measurement features from the
order's line items (left join, so orders without lines keep NULL features).

Plan at scale: lineitem is aggregated by l_orderkey (hash shuffle on the
key, partial aggregation first); orders is shuffled on the same key and the
sort-merge join reuses that partitioning.  customer grows with the orders and
joins them on o_custkey by a merge join: its size in the optimizer's eyes is
that of compressed files, and a broadcast would pass its rows, many times that
size, through the driver.  Only the columns used below reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.config import Roles, DEFAULT_ROLES
from outcomekit.sources.tables import normalise_nulls

COHORT_FEATURES = ["balance", "total", "qty_min", "qty_max", "qty_range",
                   "price_min", "price_max", "price_range", "disc_mean", "rare_qty"]


MANY_LINES = 4


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def build_cohort(spark: SparkSession, sf_dir: str, roles: Roles = DEFAULT_ROLES, outcome: str = "urgent") -> DataFrame:
    # NaN and NA tokens become NULL at the scan, so every later step skips them
    orders = normalise_nulls(driver_table(spark, sf_dir, "orders"))
    lines = normalise_nulls(driver_table(spark, sf_dir, "lineitem"))
    customer = normalise_nulls(driver_table(spark, sf_dir, "customer"))

    rare = (F.col("l_returnflag") == "A") & (F.col("l_discount") >= 0.09)
    per_order = (
        lines.groupBy("l_orderkey")
        .agg(
            F.min("l_quantity").alias("qty_min"),
            F.max("l_quantity").alias("qty_max"),
            F.min("l_extendedprice").alias("price_min"),
            F.max("l_extendedprice").alias("price_max"),
            F.avg("l_discount").alias("disc_mean"),
            F.max(F.when(rare, F.col("l_quantity"))).alias("rare_qty"),
            F.count("*").alias("n_lines"),
        )
        .withColumn("qty_range", F.col("qty_max") - F.col("qty_min"))
        .withColumn("price_range", F.col("price_max") - F.col("price_min"))
    )
    cust = customer.select(F.col("c_custkey"), F.col("c_acctbal").alias("balance"),
                           F.col("c_mktsegment").alias("segment"))
    o = orders.select(
        F.col("o_orderkey").alias(roles.stay),
        F.col("o_custkey").alias(roles.subject),
        F.col("o_orderdate").alias(roles.time),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("_urgent"),
        F.col("o_totalprice").alias("total"),
    )
    # the outcome: an urgent order, or one of more than MANY_LINES lines (which the features tell something about)
    label = {"urgent": F.col("_urgent"), "many_lines": (F.coalesce("n_lines", F.lit(0)) > MANY_LINES).cast("int")}[outcome]
    return (
        o.join(cust.hint("merge"), o[roles.subject] == cust["c_custkey"], "left")
        .join(per_order, o[roles.stay] == per_order["l_orderkey"], "left")
        .select(roles.stay, roles.subject, roles.time, label.alias(roles.label), "segment",
                *COHORT_FEATURES)
    )
