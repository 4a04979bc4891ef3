"""Table profiling (P1-P14).  Every operator is one aggregate pass that
returns a small table; nothing iterates over rows on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.functions.quantiles import exact_quantiles
from outcomekit.operators.prep import column_kinds, missing_counts, to_long


def shape(df: DataFrame) -> DataFrame:
    """Rows x columns as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First n rows in a stated order (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(*order_by).limit(n)


def column_names(df: DataFrame, n: int = 20) -> list[str]:
    """The first n column names (metadata only)."""
    return df.columns[:n]


def dtype_histogram(df: DataFrame) -> DataFrame:
    """How many columns of each type (schema only)."""
    spark = df.sparkSession
    rows = [(f.dataType.simpleString(),) for f in df.schema.fields]
    return spark.createDataFrame(rows, "dtype string").groupBy("dtype").agg(F.count(F.lit(1)).alias("n_columns"))


def kind_counts(df: DataFrame) -> DataFrame:
    """Numeric / categorical / datetime column counts (schema only)."""
    spark = df.sparkSession
    return spark.createDataFrame([(k, len(v)) for k, v in column_kinds(df).items()], "kind string, n_columns int")


def missing_by_column(df: DataFrame, limit: int | None = 10) -> DataFrame:
    """P5: columns with missing values, in column order, first ``limit``."""
    pos = {c: i for i, c in enumerate(df.columns)}
    m = missing_counts(df)
    spark = df.sparkSession
    order = spark.createDataFrame(list(pos.items()), "column_name string, column_pos int")
    out = m.join(F.broadcast(order), "column_name").where(F.col("n_missing") > 0) \
        .select("column_pos", "column_name", "n_missing", "missing_rate")
    out = out.orderBy("column_pos")
    return out.limit(limit) if limit else out


def missing_total(df: DataFrame) -> DataFrame:
    """Missing cells overall and as a share of all cells."""
    m = missing_counts(df)
    return m.agg(F.sum("n_missing").cast("bigint").alias("total_missing"),
                 (F.max("n_rows") * F.count(F.lit(1))).cast("bigint").alias("total_cells")) \
        .withColumn("missing_share", F.col("total_missing") / F.col("total_cells"))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Counts per label value (NULL dropped) and share of labelled rows."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(label).alias("_t")).first()["_t"]
    return counts.withColumn("share", F.col("n") / F.lit(float(total)) if total else F.lit(None).cast("double"))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample std, min, exact 25/50/75 % (linear), max."""
    long = to_long(df, [], cols).where(F.col("value").isNotNull())
    m = long.groupBy("feature").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                    F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                    F.max("value").alias("max"))
    q = exact_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75]).groupBy("feature").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("p25"),
        F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("p50"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("p75"))
    return m.join(q, "feature", "left").select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def duplicate_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P10: rows beyond the first of each identical group (NaN = NaN, NULL =
    NULL).  groupBy over all columns with map-side partial counts: a value
    copied a million times is one partial row per task."""
    cols = cols or df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.sum(F.col("_c") - 1).cast("bigint").alias("n_duplicates"),
                 F.count_if(F.col("_c") > 1).alias("n_duplicate_groups"),
                 F.sum("_c").cast("bigint").alias("n_rows"))


def key_card(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per key column its type, distinct count (NULL excluded) and the
    smallest value as a deterministic sample."""
    aggs = []
    for k in keys:
        aggs += [F.count_distinct(k).alias(f"d_{k}"), F.min(F.col(k).cast("string")).alias(f"s_{k}")]
    row = df.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stack = "stack({}, {}) as (column_name, dtype, n_unique, sample)".format(
        len(keys), ", ".join(f"'{k}', '{types[k]}', d_{k}, s_{k}" for k in keys))
    return row.selectExpr(stack)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values (NULL kept as a value)."""
    return df.select(col).distinct()


def conditional_counts(df: DataFrame, conds: dict[str, str]) -> DataFrame:
    """count_if for named SQL predicates, one row."""
    return df.agg(*[F.count_if(F.expr(p)).alias(n) for n, p in conds.items()])


def value_range(df: DataFrame, col: str, scale: float = 1.0) -> DataFrame:
    """Min / max and the same after a unit change (divide by ``scale``)."""
    return df.agg(F.min(col).cast("double").alias("min_value"), F.max(col).cast("double").alias("max_value")) \
        .withColumn("min_scaled", F.col("min_value") / F.lit(float(scale))) \
        .withColumn("max_scaled", F.col("max_value") / F.lit(float(scale)))
