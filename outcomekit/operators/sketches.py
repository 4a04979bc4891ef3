"""Stored, mergeable sketches per feature.

``sketch_columns`` makes one row per feature (and group): a KLL sketch for
quantiles, an HLL sketch for distinct values, counts, minimum and maximum.  Its size
depends on features x groups only.  Sketches of increments (days, folders)
are stored as a table and merged by ``merge_sketches`` without reading the old
rows again; ``sketch_quantiles`` and ``sketch_report`` read them.

They are approximate: in 99 of 100 sketches of size k a quantile's rank is off
by ``rank_error(k)`` of the rows at most (1.3 % at k = 200, 0.35 % at k = 800), a distinct count by about 1.04 / sqrt(2^lg) (1.6 % at lg = 12).
``exact_quantiles`` stays the library's default.

NULL and NaN are missing: counted in ``n_missing``, in no sketch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.operators.prep import to_long

K = 800
LG = 12


def rank_error(k: int = K) -> float:
    """Documented bound of a quantile's rank error (a share of the rows)."""
    return 2.296 / k ** 0.9723


def sketch_columns(df: DataFrame, cols: list[str], by: list[str] | None = None, k: int = K, lg: int = LG) -> DataFrame:
    """(by.., feature, n, n_missing, min, max, kll, hll): one pass, sketches are merged map-side."""
    by = list(by or [])
    long = to_long(df, by, cols)
    v = F.when(~F.isnan("value"), F.col("value"))
    # -0.0 and 0.0 are one value
    long = long.withColumn("value", F.when(v == 0, F.lit(0.0)).otherwise(v))
    return long.groupBy(*by, "feature").agg(
        F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.kll_sketch_agg_double("value", F.lit(k)).alias("kll"),
        F.hll_sketch_agg(F.col("value").cast("string"), F.lit(lg)).alias("hll"))


def merge_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketch rows of several increments (or groups) merged into one per (by, feature)."""
    return sketches.groupBy(*(by or []), "feature").agg(
        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("kll").alias("kll"), F.hll_union_agg("hll").alias("hll"))


def sketch_quantiles(sketches: DataFrame, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """(by.., feature, prob, quantile, n): the row at rank ``prob`` (no interpolation); NULL without a value."""
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    # an empty sketch has no quantiles to ask for
    none = F.array_repeat(F.lit(None).cast("double"), len(probs))
    q = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("kll", ranks)).otherwise(none)
    rows = sketches.select(*(by or []), "feature", "n", F.explode(F.arrays_zip(ranks.alias("prob"), q.alias("quantile"))).alias("_r"))
    return rows.select(*(by or []), "feature", F.col("_r.prob").alias("prob"), F.col("_r.quantile").alias("quantile"), "n")


def sketch_report(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by.., feature, n, n_missing, min, max, n_distinct)."""
    return sketches.select(*(by or []), "feature", "n", "n_missing", "min", "max",
                           F.hll_sketch_estimate("hll").alias("n_distinct"))


def fit_median_from(sketches: DataFrame) -> DataFrame:
    """C11 fit from stored sketches: (feature, fill) for ``prep.apply_impute``."""
    return sketch_quantiles(sketches, [0.5]).select("feature", F.col("quantile").alias("fill"))
