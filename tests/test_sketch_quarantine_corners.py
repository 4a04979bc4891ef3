"""Mergeable sketches, malformed CSV rows, collinear points of the ROC curve."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomekit.functions.prefix import neighbours_in_order
from outcomekit.operators import evaluate, sketches
from outcomekit.sources import quarantine
from outcomekit.sources.tables import TableMissing, read_csv_table

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("when.at", T.TimestampType()),
                       T.StructField("row", T.DoubleType()), T.StructField("note", T.StringType())])
LINES = ["id,when.at,row,note", "1,2024-01-01 10:00:00,2.5,fine", "2,bad,x,two reasons", "3,2024-01-02 00:00:00,NaN,",
         "4,2024-01-02 00:00:00", "5,2024-01-02 00:00:00,1,a,b", "", ",2024-01-02 00:00:00,1,no id",
         '6,2024-01-02 00:00:00,1e3,"a, b"', "2,bad,x,two reasons"]


def test_quarantine_keeps_every_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(LINES) + "\n")
    q = quarantine.read_csv(spark, str(tmp_path), SCHEMA, required=("id",))
    good = {r.id: r for r in q.good.collect()}
    assert q.good.schema == SCHEMA
    assert sorted(good) == [1, 3, 6] and good[3].row is None and good[3].note is None
    assert good[6].note == "a, b" and good[6].row == 1000.0
    bad = sorted((r.raw_line, r.reasons) for r in q.bad.collect())
    two = ["when.at: not timestamp", "row: not double"]
    assert bad == sorted([(LINES[2], two), (LINES[2], two), (LINES[4], [quarantine.FIELDS]),
                          (LINES[5], [quarantine.FIELDS]), (LINES[7], ["id: missing"])])
    assert {r.reason: r.n for r in q.report().collect()} == {
        quarantine.FIELDS: 2, "when.at: not timestamp": 2, "row: not double": 2, "id: missing": 1}


def test_quarantine_absent_empty_and_wrong_names(spark, tmp_path):
    with pytest.raises(TableMissing):
        quarantine.read_csv(spark, str(tmp_path / "none"), SCHEMA)
    assert quarantine.read_csv(spark, str(tmp_path / "none"), SCHEMA, must_exist=False) is None
    (tmp_path / "a.csv").write_text("")
    q = quarantine.read_csv(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert q.good.count() == q.bad.count() == 0
    with pytest.raises(ValueError):
        quarantine.read_csv(spark, str(tmp_path / "a.csv"), SCHEMA, required=("nope",))


def test_csv_scan_takes_only_absence_for_absent(spark, tmp_path):
    assert read_csv_table(spark, str(tmp_path / "none.csv"), required=False) is None
    (tmp_path / "a.csv").write_text("x,x\n1,2\n")
    with pytest.raises(Exception) as e:
        read_csv_table(spark, str(tmp_path / "a.csv"), schema="x int, x int", required=False).collect()
    assert not isinstance(e.value, TableMissing)


def test_merged_sketches_hold_the_rank_error(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=20000), np.full(10000, 0.5), [np.nan] * 50])
    rng.shuffle(x)
    df = spark.createDataFrame(pd.DataFrame({"day": rng.integers(0, 4, len(x)), "x": x, "y": np.floor(x * 100)}))
    df = df.withColumn("none", F.lit(None).cast("double"))
    stored = sketches.sketch_columns(df, ["x", "y", "none"], ["day"])
    assert stored.count() == 12
    merged = sketches.merge_sketches(stored)
    v = np.sort(x[~np.isnan(x)])
    for r in sketches.sketch_quantiles(merged, [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]).where("feature = 'x'").collect():
        low, high = np.searchsorted(v, r.quantile, "left") / len(v), np.searchsorted(v, r.quantile, "right") / len(v)
        assert low - sketches.rank_error() <= r.prob <= high + sketches.rank_error()
    rep = {r.feature: r for r in sketches.sketch_report(merged).collect()}
    assert (rep["x"].n, rep["x"].n_missing, rep["none"].n, rep["none"].n_missing) == (30000, 50, 0, 30050)
    assert (rep["x"].min, rep["x"].max) == (v[0], v[-1])
    for c, want in (("x", len(np.unique(v))), ("y", len(np.unique(np.floor(v * 100))))):
        assert rep[c].n_distinct == pytest.approx(want, rel=0.06)
    assert rep["none"].n_distinct == 0
    fills = {r.feature: r.fill for r in sketches.fit_median_from(merged).collect()}
    assert fills["none"] is None and abs(fills["x"] - np.median(v)) < 0.05


def corners_by_hand(rows):
    sc = {}
    for s, y in rows:
        sc.setdefault(s, [0, 0])[y] += 1
    order = sorted(sc, reverse=True)
    p, n = sum(v[1] for v in sc.values()), sum(v[0] for v in sc.values())
    out, tp, fp = {(float("inf"), 0.0, 0.0)}, 0, 0
    for i, s in enumerate(order):
        fp, tp = fp + sc[s][0], tp + sc[s][1]
        if i in (0, len(order) - 1) or sc[s] != sc[order[i + 1]]:
            out.add((s, fp / n, tp / p))
    return out


@pytest.mark.parametrize("per_range", [500_000, 40, 7])
def test_corners_at_any_number_of_ranges(spark, per_range):
    rnd = random.Random(per_range)
    rows = [(float(rnd.randint(0, 300)) / 7, int(rnd.random() < 0.3)) for _ in range(400)]
    few = [(5.0, 1), (3.0, 0)]
    data = [("a", s, y) for s, y in rows] + [("b", s, y) for s, y in few]
    df = spark.createDataFrame(data, "model string, score double, label int").repartition(3)
    got = evaluate.roc_corners(df, ["model"], rows_per_range=per_range).collect()
    assert {(r.threshold, r.fpr, r.tpr) for r in got if r.model == "a"} == corners_by_hand(rows)
    assert {(r.threshold, r.fpr, r.tpr) for r in got if r.model == "b"} == corners_by_hand(few)


def test_neighbours_pass_over_empty_ranges(spark):
    df = spark.createDataFrame([("g", float(i), i) for i in range(50)] + [("h", 0.0, 100), ("h", 49.0, None), ("h", 24.0, 7)],
                               "g string, o double, v int")
    got = {(r.g, r.o): (r.prev_v, r.next_v) for r in neighbours_in_order(df, "o", ["v"], ["g"], rows_per_range=5).collect()}
    assert got[("h", 24.0)] == (None, 100) and got[("h", 0.0)] == (7, None) and got[("h", 49.0)] == (None, 7)
    assert all(got[("g", float(i))] == (i + 1, i - 1) for i in range(1, 49))
