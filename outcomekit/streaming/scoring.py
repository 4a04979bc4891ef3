"""Scoring new stays as they arrive (Structured Streaming).

The batch flow's fitted state is small and static — fill values, scaler
moments, a ``PipelineModel`` — and every ``apply_*`` step is a projection,
so the same steps run unchanged on a streaming DataFrame: no state store,
no shuffle.  Output rows carry the event time, so a downstream windowed
aggregate (with a watermark) can track the outcome rate over time.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.operators import prep


def score_stream(stream: DataFrame, fills: DataFrame, model: PipelineModel, features: list[str],
                 key: str = "stay_id", time_col: str | None = None, name: str = "model") -> DataFrame:
    """Impute with the fitted fills and score with the fitted pipeline."""
    from pyspark.ml.functions import vector_to_array
    ready = prep.apply_impute(stream, fills)
    out = model.transform(ready)
    s = vector_to_array(F.col("probability"))[1] if "probability" in out.columns \
        else vector_to_array(F.col("rawPrediction"))[1]
    cols = [F.lit(name).alias("model"), key, s.alias("score"), F.col("prediction").cast("int").alias("prediction")]
    if time_col:
        cols.append(time_col)
    return out.select(*cols)


def windowed_outcome_rate(scored: DataFrame, time_col: str, window: str = "1 day",
                          watermark: str = "1 day") -> DataFrame:
    """Predicted-positive rate per event-time window (late rows bounded by the watermark)."""
    return (scored.withWatermark(time_col, watermark)
            .groupBy(F.window(time_col, window), "model")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("predicted_rate"),
                 F.avg("score").alias("mean_score")))
