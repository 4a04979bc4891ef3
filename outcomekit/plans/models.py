"""MLlib learners, the fit-and-score loop, cross-validation and random
search (M1-M16, T16).

Each learner is a ``Pipeline``: VectorAssembler -> StandardScaler (fitted on
train only) -> classifier, so a fitted model is one ``PipelineModel`` that
can be saved, loaded and applied to batch or streaming rows.  Fits are
distributed (treeAggregate jobs); nothing here collects training rows.

Re-aimed learners (external boosting libraries and kernel SVM are not part
of Spark): XGBoost -> GBTClassifier with row / column subsampling and a
positive-class weight; LightGBM -> GBTClassifier with min 20 rows per leaf
and weight n_neg / n_pos; SVM -> LinearSVC with balanced weights.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.config import SEED
from outcomekit.operators import balance, perceptron
from outcomekit.operators.prep import gathered
from outcomekit.session import ensure_checkpoint_dir


@dataclass
class LearnerSpec:
    name: str
    balance: str = "none"          # none | balanced | pos_weight | unbalance | smote
    pos_weight: float = 1.0
    params: dict = field(default_factory=dict)


def _classifier(kind: str, n_features: int, weight: str | None, params: dict):
    w = {"weightCol": weight} if weight else {}
    if kind == "logistic":
        return LogisticRegression(featuresCol="features", labelCol="label", **w, **params)
    if kind == "forest":
        return RandomForestClassifier(featuresCol="features", labelCol="label", seed=SEED, **w, **params)
    if kind == "gbt":
        return GBTClassifier(featuresCol="features", labelCol="label", seed=SEED, **w, **params)
    if kind == "linear_svm":
        return LinearSVC(featuresCol="features", labelCol="label", **w, **params)
    if kind == "mlp":
        layers = [n_features, *params.pop("hidden", [100, 50]), 2]
        return MultilayerPerceptronClassifier(featuresCol="features", labelCol="label", layers=layers,
                                              seed=SEED, **params)
    if kind == "naive_bayes":
        return NaiveBayes(featuresCol="features", labelCol="label", modelType="gaussian", **w, **params)
    raise ValueError(kind)


# Learner presets mirroring the reference's model table.
LEARNERS: dict[str, tuple[str, LearnerSpec]] = {
    "logistic_regression": ("logistic", LearnerSpec("logistic_regression", "balanced",
                                                    params={"maxIter": 1000, "elasticNetParam": 0.0})),
    # unbounded depth is capped at 10: Spark grows trees level by level, one
    # distributed pass (and one node-statistics aggregate) per level
    "random_forest": ("forest", LearnerSpec("random_forest", "balanced", 3.0,
                                            params={"numTrees": 200, "minInstancesPerNode": 5, "maxDepth": 10,
                                                    "maxMemoryInMB": 512})),
    "xgboost_like": ("gbt", LearnerSpec("xgboost_like", "smote_pos_weight", 10.0,
                                        params={"maxIter": 100, "maxDepth": 5, "stepSize": 0.3,
                                                "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"})),
    "lightgbm_like": ("gbt", LearnerSpec("lightgbm_like", "unbalance",
                                         params={"maxIter": 100, "maxDepth": 5, "stepSize": 0.1,
                                                 "minInstancesPerNode": 20})),
    "gradient_boosting": ("gbt", LearnerSpec("gradient_boosting", "smote",
                                             params={"maxIter": 200, "stepSize": 0.05, "maxDepth": 5,
                                                     "minInstancesPerNode": 5})),
    # up to the reference's 500 steps; its early stopping is in early_stop.fit_network
    "neural_network": ("mlp", LearnerSpec("neural_network", "smote",
                                          params={"maxIter": 500, "tol": 1e-4, "hidden": [100, 50]})),
    "linear_svm": ("linear_svm", LearnerSpec("linear_svm", "balanced", params={"maxIter": 100})),
    "naive_bayes": ("naive_bayes", LearnerSpec("naive_bayes", "none")),
}


def build_pipeline(kind: str, features: list[str], weight: str | None = None, **params) -> Pipeline:
    asm = VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="error")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    stages = [asm] if kind == "naive_bayes" else [asm, scaler]
    if kind == "naive_bayes":
        asm.setOutputCol("features")
    return Pipeline(stages=stages + [_classifier(kind, len(features), weight, dict(params))])


def prepare_training(train: DataFrame, features: list[str], spec: LearnerSpec, key: str = "stay_id",
                     label: str = "label") -> tuple[DataFrame, str | None]:
    """Rows and weight column for a learner's balance method."""
    if spec.balance == "balanced":
        return balance.with_weights(train, balance.balanced_weights(train, label), label), "weight"
    if spec.balance in ("pos_weight", "unbalance"):
        if spec.balance == "pos_weight":
            w = spec.pos_weight
        else:
            c = balance.class_counts(train, label)
            w = c.get(0, 0) / c[1] if c.get(1) else 1.0
        return train.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(w))).otherwise(F.lit(1.0))), "weight"
    if spec.balance in ("smote", "smote_pos_weight"):
        out, _ = balance.smote(train, features, key, label, ratio=1.0, k=5, adaptive_k=True)
        if spec.balance == "smote":
            return out, None
        return out.withColumn("weight", F.when(F.col(label) == 1, F.lit(spec.pos_weight)).otherwise(F.lit(1.0))), "weight"
    return train, None


def _fit(pipe: Pipeline, rows: DataFrame) -> PipelineModel:
    """The perceptron's steps are ``perceptron.fit_perceptron``'s, those of the other learners MLlib's."""
    learner = pipe.getStages()[-1]
    if not isinstance(learner, MultilayerPerceptronClassifier):
        return pipe.fit(rows)
    scaled = Pipeline(stages=pipe.getStages()[:-1]).fit(rows)
    get = learner.getOrDefault
    model = perceptron.fit_perceptron(scaled.transform(rows), list(get("layers")), get("maxIter"), get("tol"), get("seed"),
                                      label=get("labelCol"))
    return PipelineModel(stages=[*scaled.stages, model])


def fit_learner(name: str, train: DataFrame, features: list[str], key: str = "stay_id",
                label: str = "label", overrides: dict | None = None) -> PipelineModel:
    """``overrides`` replace parameters of the preset; ``balance`` and ``pos_weight`` those of its balance."""
    kind, spec = LEARNERS[name]
    params = {**spec.params, **(overrides or {})}
    spec = LearnerSpec(spec.name, params.pop("balance", spec.balance), params.pop("pos_weight", spec.pos_weight))
    if kind == "logistic":
        # scikit-learn C = 1 on a summed loss ~ regParam 1/n on Spark's mean loss
        params.setdefault("regParam", 1.0 / max(1, train.count()))
    rows, weight = prepare_training(train.select(key, label, *features), features, spec, key, label)
    if not spec.balance.startswith("smote"):
        return _fit(build_pipeline(kind, features, weight, **params), gathered(rows))
    # scaler and learner both read the resampled rows: run the neighbour join once
    rows = rows.persist()
    try:
        return _fit(build_pipeline(kind, features, weight, **params), gathered(rows))
    finally:
        rows.unpersist()


def score(model: PipelineModel, df: DataFrame, name: str, key: str = "stay_id", label: str = "label") -> DataFrame:
    """(model, key, label, score, prediction); score = P(class 1), or the
    margin for LinearSVC."""
    out = model.transform(df)
    if "probability" in out.columns:
        s = vector_to_array(F.col("probability"))[1]
    else:
        s = vector_to_array(F.col("rawPrediction"))[1]
    return out.select(F.lit(name).alias("model"), key, label, s.alias("score"),
                      F.col("prediction").cast("int").alias("prediction"))


def fit_and_score(names: list[str], train: DataFrame, test: DataFrame, features: list[str],
                  key: str = "stay_id", label: str = "label", parallelism: int = 4) -> tuple[DataFrame, DataFrame]:
    """Fit each learner and score with it; a failure of either becomes a row in the error table and
    the loop goes on.  Fits are submitted from ``parallelism`` driver threads
    (Spark runs their jobs concurrently, as ``CrossValidator`` does).
    Returns (predictions, errors)."""
    from concurrent.futures import ThreadPoolExecutor

    spark = train.sparkSession
    ensure_checkpoint_dir(spark)

    def one(n):
        try:
            m = fit_learner(n, train, features, key, label)
            # scored here and now, into the shared folder: a failure of the scoring stays in this row too
            return n, score(m, test, n, key, label).checkpoint(), None
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            return n, None, f"{type(exc).__name__}: {exc}"[:500]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(one, names))
    preds = [p for _, p, _ in results if p is not None]
    errors = [(n, e) for n, _, e in results if e is not None]
    err = spark.createDataFrame(errors, "model string, error string")
    if not preds:
        none = test.limit(0).select(F.lit("").alias("model"), key, label, F.lit(0.0).alias("score"),
                                    F.lit(0).alias("prediction"))
        return none, err
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return out, err


def importance_table(model: PipelineModel, features: list[str], name: str, top: int = 20) -> DataFrame:
    """Feature importances (trees) or |coefficients| (linear),
    largest first; a learner with neither gives NULL importances."""
    from pyspark.sql import SparkSession
    clf = model.stages[-1]
    if hasattr(clf, "featureImportances"):
        vals, kind = clf.featureImportances.toArray().tolist(), "importance"
    elif hasattr(clf, "coefficients"):
        vals, kind = [abs(x) for x in clf.coefficients.toArray().tolist()], "abs_coefficient"
    else:
        vals, kind = [None] * len(features), "none"
    spark = SparkSession.getActiveSession()
    rows = [(name, f, float(v) if v is not None else None, kind) for f, v in zip(features, vals)]
    df = spark.createDataFrame(rows, "model string, feature string, importance double, kind string")
    return df.orderBy(F.col("importance").desc_nulls_last(), "feature").limit(top)


def random_search(train: DataFrame, features: list[str], kind: str, grid: dict[str, list], n_draws: int,
                  folds: int = 3, seed: int = SEED, parallelism: int = 4, label: str = "label",
                  weight: str | None = None, fold_col: str = "") -> tuple[PipelineModel, DataFrame]:
    """Sample ``n_draws`` parameter maps from the grid (seeded), score
    each with k-fold CV on the exact AUC, refit the best on all training rows.
    Folds are those of ``fold_col`` (see ``stratified_folds``), or random.
    Returns (best model, table of (draw, params, mean_auc))."""
    pipe = build_pipeline(kind, features, weight)
    clf = pipe.getStages()[-1]
    b = ParamGridBuilder()
    for pname, values in grid.items():
        b = b.addGrid(clf.getParam(pname), values)
    maps = b.build()
    rnd = random.Random(seed)
    draws = maps if len(maps) <= n_draws else rnd.sample(maps, n_draws)
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC",
                                       numBins=0)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=draws, evaluator=ev, numFolds=folds, seed=seed,
                        parallelism=parallelism, foldCol=fold_col)
    model = cv.fit(train)
    spark = train.sparkSession
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)), float(a))
            for i, (m, a) in enumerate(zip(draws, model.avgMetrics))]
    table = spark.createDataFrame(rows, "draw int, params string, mean_auc double")
    return model.bestModel, table
