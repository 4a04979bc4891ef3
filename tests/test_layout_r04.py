"""Trees read their rows from few partitions; margins of the kernel SVM's folds are computed once."""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from outcomekit.operators import bootstrap, kernel, prep
from outcomekit.plans import tuning


def numbers(spark, n=300, parts=40):
    return spark.range(n).select(F.col("id").alias("stay_id"), (F.col("id") % 3 == 0).cast("int").alias("label"),
                                 (F.col("id") % 7 + F.col("id") % 3).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("y")).repartition(parts)


def test_balanced_forest_reads_gathered_rows(spark, monkeypatch):
    seen, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: seen.append((df.rdd.getNumPartitions(), self.getCacheNodeIds())) or fit(self, df))
    rows = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(numbers(spark))
    as_they_lie = bootstrap.fit_balanced_forest(rows, 1, "stay_id", maxDepth=3)
    monkeypatch.setattr(prep, "ROWS_A_TASK", 100)
    trees = bootstrap.fit_balanced_forest(rows, 2, "stay_id", maxDepth=3)
    assert seen[0] == (40, True) and [s[0] <= max(3, spark.sparkContext.defaultParallelism) for s in seen[1:]] == [True, True]
    # all values are candidate cuts of so few rows: the layout changes nothing
    assert trees[0].toDebugString.split("\n", 1)[1] == as_they_lie[0].toDebugString.split("\n", 1)[1]


def test_rows_of_a_task(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert prep.few(100_000) and not prep.few(100_001)
    df = spark.range(1000).repartition(5 * cores)
    monkeypatch.setattr(prep, "FEW_ROWS", 999)
    # beyond the few, rows of up to ROWS_A_TASK a core go to as many partitions as there are cores
    assert prep.ROWS_A_TASK >= 1_000_000 and prep.gathered(df).rdd.getNumPartitions() == cores


def test_margins_of_the_folds_are_kept_for_the_sigmoid(spark, monkeypatch):
    levels, fit = [], kernel.fit_platt
    monkeypatch.setattr(kernel, "fit_platt", lambda margins: levels.append(margins.storageLevel.useMemory) or fit(margins))
    kernel.fit_kernel_svm(numbers(spark, 200, 2), ["x", "y"], components=4, folds=2, maxIter=2)
    assert levels == [True]


def test_learners_in_folds_do_not_carry_the_plan_of_the_rows(spark, monkeypatch):
    plans, fit = [], tuning.fit_learner
    monkeypatch.setattr(tuning, "fit_learner", lambda name, df, *a: plans.append(df._jdf.queryExecution().toString()) or fit(name, df, *a))
    rows = numbers(spark, 90, 2).withColumn("fold", (F.floor(F.col("stay_id") / 3) % 3).cast("int"))
    assert "Range" in rows._jdf.queryExecution().toString()
    tuning.cross_validate(["naive_bayes"], rows, ["x", "y"])
    tuning.tune("naive_bayes", rows, ["x", "y"], [{}])
    assert len(plans) == 8 and not any("Range" in p for p in plans)
