"""Exact quantiles (linear interpolation, like pandas / numpy / SQL
``quantile_cont``) without pulling a whole group into one task.

Rows are first collapsed to (group, value, count), so a value repeated for any
share of the rows is one row, pre-aggregated before the shuffle.  Running
totals of the counts in value order (``functions.prefix``: value ranges, no
single sort of a group) give each value its span of ranks; a quantile's two
ranks each fall in one span.  No window runs over raw rows, whatever the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.functions.prefix import running_totals


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    *, rows_per_range: int = 500_000) -> DataFrame:
    """Return ``keys + [prob, quantile, n]``.

    NULL and NaN values are missing: neither ranked nor counted in ``n``.
    Groups without a value do not appear.  A NULL key is a group of its own.
    """
    v = F.col(value).cast("double")
    # the keys travel as one struct, whose NULL fields compare as equal
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(1).alias("_one"))
    base = df.where(v.isNotNull() & ~F.isnan(v)).select(key.alias("_k"), v.alias("_v"))
    # counted, cut into ranges, summed by range and ranked: keep it (MEMORY_AND_DISK; lost blocks are recomputed)
    counts = base.groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_c")).cache()
    spans = running_totals(counts, "_v", ["_c"], by=["_k"], descending=False, rows_per_range=rows_per_range)
    sizes = counts.groupBy("_k").agg(F.sum("_c").alias("n"))
    ranks = (
        sizes.select("_k", "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
        .withColumn("_pos", (F.col("n") - 1) * F.col("prob"))
        .select("_k", "n", "prob", (F.floor("_pos") + 1).alias("_lo"), (F.ceil("_pos") + 1).alias("_hi"),
                (F.col("_pos") - F.floor("_pos")).alias("_frac"))
    )
    holds = lambda r: (F.col(r) <= F.col("cum__c")) & (F.col(r) > F.col("cum__c") - F.col("_c"))
    found = (
        spans.join(ranks, "_k").where(holds("_lo") | holds("_hi"))
        .groupBy("_k", "prob", "n", "_frac")
        .agg(F.max(F.when(holds("_lo"), F.col("_v"))).alias("_a"), F.max(F.when(holds("_hi"), F.col("_v"))).alias("_b"))
    )
    return found.select(*[F.col(f"_k.{k}").alias(k) for k in keys], "prob",
                        (F.col("_a") + F.col("_frac") * (F.col("_b") - F.col("_a"))).alias("quantile"), "n")
