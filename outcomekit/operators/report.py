"""Result ranking and report tables (R1-R9, J7).  Inputs are metric tables
with one row per model, so windows here run over a handful of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Metric order of the comparison views.
METRICS = ["accuracy", "precision", "recall", "f1", "auc"]


def unpivot_metrics(wide: DataFrame, metrics: list[str] = METRICS, key: str = "model") -> DataFrame:
    """J7 inverse: (model, metric, value, metric_pos) long rows."""
    long = wide.select(key, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [key], metrics, "metric", "value")
    pos = F.create_map(*[x for i, m in enumerate(metrics) for x in (F.lit(m), F.lit(i + 1))])
    return long.withColumn("metric_pos", pos[F.col("metric")])


def pivot_metrics(long: DataFrame, metrics: list[str] = METRICS, key: str = "model") -> DataFrame:
    """Long (model, metric, value) -> one row per model, one column per metric."""
    return long.groupBy(key).pivot("metric", metrics).agg(F.first("value"))


def rank_models(metrics: DataFrame, by: str = "auc", key: str = "model") -> DataFrame:
    """Rank by a metric, descending; ties by name."""
    w = Window.orderBy(F.col(by).desc(), F.col(key))
    return metrics.withColumn("rank", F.row_number().over(w))


def best_model(metrics: DataFrame, by: str = "auc", key: str = "model") -> DataFrame:
    """R2: the first model by a metric (ties -> smallest name)."""
    return metrics.orderBy(F.col(by).desc(), F.col(key)).limit(1)


def leaderboard(metrics: DataFrame, metric_names: list[str] = METRICS, key: str = "model") -> DataFrame:
    """R3 + R4: per metric, models sorted by value (position 1 = best)."""
    long = unpivot_metrics(metrics, metric_names, key)
    w = Window.partitionBy("metric").orderBy(F.col("value").desc(), F.col(key))
    return long.withColumn("position", F.row_number().over(w))


def bands(metrics: DataFrame) -> DataFrame:
    """Quality bands for AUC, precision and recall."""
    auc, p, r = F.col("auc"), F.col("precision"), F.col("recall")
    return metrics.select(
        "model",
        F.when(auc > 0.8, "good").when(auc > 0.7, "moderate").otherwise("weak").alias("auc_band"),
        F.when(p > 0.8, "high").when(p > 0.6, "medium").otherwise("low").alias("precision_band"),
        F.when(r > 0.7, "high").when(r > 0.5, "medium").otherwise("low").alias("recall_band"))


def display(metrics: DataFrame, cols: list[str], places: int = 4) -> DataFrame:
    """Fixed-decimal projection for display."""
    return metrics.withColumns({c: F.round(F.col(c), places) for c in cols})
