"""Cleaning stages: fitted, saved, loaded, on a batch and on a stream."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from outcomekit.operators import prep
from outcomekit.operators.stages import ClampNegatives, Fill, MissingCut, Standardise

NUM = ["bal", "odd.name", "rare", "flat", "none"]


def table(spark, n=200):
    null = lambda every: (F.col("id") % every == 0)
    return spark.range(n).select(
        "id", (F.col("id") % 2).cast("int").alias("label"),
        F.when(~null(7), F.col("id") % 23 - 5.0).alias("bal"),
        F.when(~null(5), (F.col("id") % 2) + (F.col("id") % 9) / 10).alias("odd.name"),
        F.when(null(3), F.lit(1.5)).alias("rare"), F.lit(4.0).alias("flat"),
        F.lit(None).cast("double").alias("none"),
        F.when(~null(4), F.when(F.col("id") % 3 == 0, "a").otherwise("b")).alias("kind"))


def cleaning():
    return [ClampNegatives(["bal"]), MissingCut(NUM, 0.5), Fill(NUM, "median"), Fill(["kind"], "mode"), Standardise(NUM)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stages_equal_the_fit_and_apply_functions(spark):
    df = table(spark)
    model = Pipeline(stages=cleaning()).fit(df)
    assert model.stages[1].kept == ["bal", "odd.name", "flat"] and model.stages[1].get("dropped") == ["rare", "none"]
    kept = model.stages[1].kept
    c = prep.clamp_columns(df, ["bal"])
    c = c.select("id", "label", *[F.col(f"`{k}`") for k in kept], "kind")
    c = prep.apply_mode(prep.apply_impute(c, prep.fit_impute(c, kept)), prep.fit_mode(c, ["kind"]))
    assert rows(model.transform(df)) == rows(prep.apply_standardiser(c, prep.fit_standardiser(c, kept)))


def test_saved_pipeline_scores_a_stream_like_a_batch(spark, tmp_path):
    df = table(spark).drop("odd.name")
    cols = ["bal", "rare", "flat", "none"]
    model = Pipeline(stages=[ClampNegatives(["bal"]), MissingCut(cols, 0.5), Fill(cols, "mean"), Fill(["kind"], "mode"),
                             Standardise(cols), VectorAssembler(inputCols=["bal", "flat"], outputCol="features"),
                             LogisticRegression(maxIter=5)]).fit(df)
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    pick = lambda d: d.select("id", "bal", "kind", vector_to_array("probability")[1].alias("score"))
    want = rows(pick(model.transform(df)))
    other = spark.newSession()
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = other.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (pick(loaded.transform(stream)).writeStream.format("memory").queryName("scored_by_stages")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start())
    q.awaitTermination(120)
    assert rows(other.table("scored_by_stages")) == want
    assert rows(pick(loaded.transform(df))) == want


def test_empty_table_and_unknown_columns(spark):
    df = table(spark).where("id < 0")
    m = Pipeline(stages=[Fill(["bal"]), Standardise(["bal"])]).fit(df)
    assert m.transform(table(spark, 8)).where("id = 1").first().bal == -4.0
    cut = MissingCut(["bal"]).fit(df)
    assert cut.kept == []
    with pytest.raises(ValueError):
        Fill(["bal"], "guess").fit(table(spark, 5))
