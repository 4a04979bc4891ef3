"""Class-imbalance operators.

SMOTE here is deterministic: the number of synthetic rows a minority row
seeds, the neighbour it pairs with and the interpolation step all come from
md5 of (row id, sample index), so reruns — and a SQL re-implementation —
give the same rows.  Neighbours come from the exact pruned kNN in
``operators.neighbours`` (no all-pairs join).  Per-row counts use the
row's position in hash order (range-bucketed running count), so no task
ever holds all minority rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.config import SMOTE_K, SMOTE_RATIO
from outcomekit.functions.expr import hash_unit
from outcomekit.functions.prefix import running_totals
from outcomekit.operators.lsh import LshPlan, knn_lsh
from outcomekit.operators.neighbours import knn


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """w_c = n / (n_classes * n_c), one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").alias("_t"), F.count(F.lit(1)).alias("_k")).first()
    return counts.withColumn("weight", F.lit(float(tot["_t"])) / (F.lit(float(tot["_k"])) * F.col("n")))


def with_weights(df: DataFrame, weights: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Attach a class-weight table (one row per class) as ``weightCol``."""
    return df.join(F.broadcast(weights.select(label, F.col("weight").alias(out))), label)


def pos_weights(df: DataFrame, label: str = "label", fixed_pos: float = 3.0) -> DataFrame:
    """Fixed {0: 1, 1: w} and is_unbalance (n_neg / n_pos for class 1)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    c = class_counts(df, label)
    ratio = (c.get(0, 0) / c[1]) if c.get(1) else None
    return counts.select(label, "n",
                         F.when(F.col(label) == 1, F.lit(fixed_pos)).otherwise(F.lit(1.0)).alias("w_fixed"),
                         F.when(F.col(label) == 1, F.lit(ratio)).otherwise(F.lit(1.0)).cast("double").alias("w_unbalance"))


def smote_target(n_min: int, n_maj: int, ratio: float) -> int:
    """Synthetic rows needed so that minority / majority = ratio (floor)."""
    return max(0, int(math.floor(ratio * n_maj)) - n_min)


def smote(df: DataFrame, features: list[str], key: str, label: str = "label",
          ratio: float = SMOTE_RATIO, k: int = SMOTE_K, minority: int = 1,
          adaptive_k: bool = False, plan: LshPlan | None = None) -> tuple[DataFrame, DataFrame]:
    """B1 / B2: returns (resampled rows, neighbour table).

    With a ``plan`` neighbours come from ``lsh.knn_lsh``; a row for which fewer
    than k were found takes its neighbour among those, and a row without any
    is copied, so the number of synthetic rows is the same.

    Resampled = originals (``is_synthetic`` false) union synthetic rows; a
    synthetic row keeps its seed row's key, label and a ``sample_idx``."""
    counts = class_counts(df, label)
    n_min = counts.get(minority, 0)
    n_maj = sum(v for c, v in counts.items() if c != minority)
    if adaptive_k:
        k = min(k, n_min - 1)
    n_syn = smote_target(n_min, n_maj, ratio)
    if n_syn and not adaptive_k and n_min <= k:
        raise ValueError(f"{k} neighbours wanted, but only {n_min} minority rows; set adaptive_k or a smaller k")
    orig = df.withColumn("is_synthetic", F.lit(False)).withColumn("sample_idx", F.lit(None).cast("int"))
    if n_syn == 0 or n_min < 2 or k < 1:
        return orig, df.sparkSession.createDataFrame([], f"{key} long, nn_id long, dist double, nn_rank int")
    mins = df.where(F.col(label) == minority)
    if plan is None:
        nn = knn(mins, mins, key, key, features, k, exclude_self=True)
    else:
        nn = knn_lsh(mins, mins, key, key, features, k, plan, exclude_self=True)

    # each minority row seeds floor((j+1) S / M) - floor(j S / M) rows, j = its
    # position in md5 order: exactly S in total, spread evenly
    h = mins.select(key).withColumn(
        "_o", F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 13), 16, 10).cast("bigint").cast("double")) \
        .withColumn("_one", F.lit(1))
    pos = running_totals(h, "_o", ["_one"], descending=False, tiebreak=[key]) \
        .select(key, (F.col("cum__one") - 1).alias("_j"))
    j = F.col("_j").cast("double")       # _j * S passes the range of a long
    per = pos.select(key, (F.floor((j + 1) * n_syn / n_min) - F.floor(j * n_syn / n_min))
                     .cast("int").alias("_m")).where(F.col("_m") > 0)
    samples = per.select(key, F.explode(F.sequence(F.lit(0), F.col("_m") - 1)).alias("sample_idx"))
    samples = samples.withColumn(
        "nn_rank", (F.floor(hash_unit(F.col(key), F.col("sample_idx"), F.lit("nn")) * k) + 1).cast("int")) \
        .withColumn("_lam", hash_unit(F.col(key), F.col("sample_idx"), F.lit("lam")))
    if plan is not None:
        have = nn.groupBy(key).agg(F.max("nn_rank").alias("_have"))
        samples = samples.join(have, key, "left").withColumn("nn_rank", F.pmod(F.col("nn_rank") - 1, F.col("_have")) + 1).drop("_have")
    pairs = samples.join(nn.select(key, "nn_rank", "nn_id"), [key, "nn_rank"], "left").withColumn("nn_id", F.coalesce("nn_id", key))
    seed = mins.select(key, label, *[F.col(f"`{f}`").alias(f) for f in features])
    other = mins.select(F.col(key).alias("nn_id"), *[F.col(f"`{f}`").alias(f"_n_{f}") for f in features])
    syn = pairs.join(seed, key).join(other, "nn_id").select(
        key, label,
        *[(F.col(f) + F.col("_lam") * (F.col(f"_n_{f}") - F.col(f))).alias(f) for f in features],
        F.lit(True).alias("is_synthetic"), F.col("sample_idx").cast("int").alias("sample_idx"))
    out = orig.select(key, label, *features, "is_synthetic", "sample_idx").unionByName(syn)
    return out, nn


def balance_report(stages: DataFrame, label: str = "label") -> DataFrame:
    """Counts and shares per (stage, label); ``stages`` has a ``stage`` column."""
    from pyspark.sql import Window
    c = stages.groupBy("stage", label).agg(F.count(F.lit(1)).alias("n"))
    # window over (stage) on a (stages x classes)-row table
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("stage")))
