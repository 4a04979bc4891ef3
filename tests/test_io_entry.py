import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from outcomekit.plans import models
from outcomekit.plans.prepared import prepare
from outcomekit.sources import sinks
from outcomekit.sources.tables import TableMissing, load_table
from outcomekit.streaming.scoring import score_stream
from conftest import SF_SMOKE


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and set(df.columns) == {"feature", "mean", "std", "mean_0", "mean_1", "diff"}


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 60


def test_guarded_scan(spark):
    with pytest.raises(TableMissing):
        load_table(spark, "/tmp/definitely-not-here.parquet")
    assert load_table(spark, "/tmp/definitely-not-here.parquet", required=False) is None


def test_table_and_model_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="outcomekit-io-", dir="/tmp")
    p = prepare(spark, SF_SMOKE)
    sinks.write_table(p.fills, os.path.join(root, "fills"))
    back = spark.read.parquet(os.path.join(root, "fills"))
    assert sorted(back.collect()) == sorted(p.fills.collect())
    m = models.fit_learner("naive_bayes", p.train, p.features)
    sinks.save_models(spark, {"naive_bayes": m}, os.path.join(root, "models"))
    loaded = sinks.load_models(spark, os.path.join(root, "models"))
    a = models.score(m, p.test, "nb").orderBy("stay_id").collect()
    b = models.score(loaded["naive_bayes"], p.test, "nb").orderBy("stay_id").collect()
    assert a == b
    sinks.write_report(spark, ["best model: nb", "auc: 0.5"], os.path.join(root, "report"))
    assert "best model" in sinks.read_report(spark, os.path.join(root, "report"))


def test_streaming_scoring(spark):
    root = tempfile.mkdtemp(prefix="outcomekit-stream-", dir="/tmp")
    p = prepare(spark, SF_SMOKE)
    m = models.fit_learner("naive_bayes", p.train, p.features)
    p.test.select("stay_id", *p.features).write.mode("overwrite").parquet(os.path.join(root, "in"))
    schema = spark.read.parquet(os.path.join(root, "in")).schema
    stream = spark.readStream.schema(schema).parquet(os.path.join(root, "in"))
    scored = score_stream(stream, p.fills, m, p.features)
    q = scored.writeStream.format("memory").queryName("scored_stays").outputMode("append") \
        .option("checkpointLocation", os.path.join(root, "ckpt")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("scored_stays").count() == p.test.count()


def test_csv_scan_normalises_na_tokens(spark):
    from outcomekit.sources.tables import read_csv_table
    root = tempfile.mkdtemp(prefix="outcomekit-csv-", dir="/tmp")
    path = os.path.join(root, "stays.csv")
    with open(path, "w") as fh:
        fh.write("SUBJECT_ID,ADMITTIME,weight_kg,note\n1,2024-01-01 10:00:00,NaN,NA\n2,bad,3.5,ok\n3,,N/A,None\n")
    df = read_csv_table(spark, path, "SUBJECT_ID long, ADMITTIME string, weight_kg double, note string")
    rows = {r.SUBJECT_ID: r for r in df.collect()}
    assert rows[1].weight_kg is None and rows[1].note is None
    assert rows[2].weight_kg == 3.5 and rows[2].note == "ok"
    assert rows[3].ADMITTIME is None and rows[3].note is None
    assert read_csv_table(spark, os.path.join(root, "missing.csv"), required=False) is None


def test_windowed_outcome_rate_batch(spark):
    from outcomekit.streaming.scoring import windowed_outcome_rate
    df = spark.createDataFrame(
        [("m", 0.9, 1, "2024-01-01 01:00:00"), ("m", 0.1, 0, "2024-01-01 05:00:00"),
         ("m", 0.8, 1, "2024-01-02 01:00:00")], "model string, score double, prediction int, t string") \
        .withColumn("t", F.to_timestamp("t"))
    out = {r.window.start.day: r for r in windowed_outcome_rate(df, "t").collect()}
    assert out[1].n == 2 and out[1].predicted_rate == 0.5 and out[2].n == 1
