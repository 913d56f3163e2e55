"""Classifiers: training, tuning, saving, run log."""

from __future__ import annotations

import time
from collections.abc import Mapping
from contextlib import contextmanager
from datetime import datetime

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.fixed_values import CV_FOLDS, SEED
from wordtide.functions.keys import fold, run_id
from wordtide.operators.boosted_trees import SparseGBTClassifier
from wordtide.schemas import RUN_RECORD

TFIDF, WORD2VEC = "tfidf_features", "word2vec_features"

# The models, their settings and the values tried in tuning.
MODELS = {
    "Random Forest": (
        RandomForestClassifier,
        {"featuresCol": TFIDF, "maxDepth": 5, "minInstancesPerNode": 2, "seed": SEED},
        {"numTrees": [20, 50]},
    ),
    "Linear SVM": (LinearSVC, {"featuresCol": TFIDF, "regParam": 0.1}, {"maxIter": [10, 20]}),
    "MLP": (
        MultilayerPerceptronClassifier,
        {"featuresCol": WORD2VEC, "blockSize": 32, "seed": SEED},
        {"maxIter": [10, 20]},
    ),
    "Logistic Regression": (LogisticRegression, {"featuresCol": TFIDF, "maxIter": 10}, {}),
    "Naive Bayes": (NaiveBayes, {"featuresCol": TFIDF}, {}),
    "Gradient-Boosted Trees": (SparseGBTClassifier, {"featuresCol": TFIDF, "maxIter": 10, "seed": SEED}, {}),
}

# The models that are trained, compared and published together.
COMPARED = ["Random Forest", "Linear SVM", "MLP"]


# Hidden and output units of the perceptron; its input is as wide as the vectors.
MLP_UNITS = [16, 2]


def vector_size(df: DataFrame, column: str) -> int:
    """Size of a vector column: from its metadata, or else from the first row that has one."""
    attributes = df.schema[column].metadata.get("ml_attr", {})
    if "num_attrs" in attributes:
        return int(attributes["num_attrs"])
    first = df.where(F.col(column).isNotNull()).select(column).first()
    if first is None:
        raise ValueError(f"{column} has no vectors")
    return len(first[0])


def estimator_of(name: str, train: DataFrame | None = None) -> tuple[Estimator, dict[str, list]]:
    """The model's estimator and the values to try; ``train`` gives the width that a perceptron needs."""
    kind, settings, values = MODELS[name]
    estimator = kind(labelCol="label", **settings)
    if name == "MLP" and train is not None:
        estimator.setLayers([vector_size(train, estimator.getFeaturesCol()), *MLP_UNITS])
    return estimator, values


def param_grid(estimator: Estimator, values: Mapping[str, list]) -> list:
    builder = ParamGridBuilder()
    for name, choices in values.items():
        builder = builder.addGrid(estimator.getParam(name), choices)
    return builder.build()


@contextmanager
def persisted(df: DataFrame):
    """Keep ``df`` in executor memory and on disk for the length of a block."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def fit(name: str, train: DataFrame) -> Model:
    """One model with the first value of each tuning list."""
    estimator, values = estimator_of(name, train)
    with persisted(train.select("label", estimator.getFeaturesCol())) as frame:
        return estimator.fit(frame, {estimator.getParam(k): v[0] for k, v in values.items()})


def cross_validate(
    name: str, train: DataFrame, folds: int = CV_FOLDS, parallelism: int = 2
) -> tuple[Model, float, list[float]]:
    """Tune one model on F1. Returns the best model, the seconds taken and the mean F1 of each setting.

    Folds follow from the id, so they are the same on every run and layout.
    """
    estimator, values = estimator_of(name, train)
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=param_grid(estimator, values),
        evaluator=MulticlassClassificationEvaluator(metricName="f1"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=SEED,
    )
    columns = train.select("label", estimator.getFeaturesCol(), fold(F.col("id"), folds).alias("fold"))
    started = time.monotonic()
    with persisted(columns) as frame:
        tuned = validator.fit(frame)
    return tuned.bestModel, time.monotonic() - started, list(tuned.avgMetrics)


def model_slug(name: str) -> str:
    return name.lower().replace(" ", "_")


def save_model(model: Model, base: str, name: str) -> str:
    path = f"{base}/{model_slug(name)}"
    model.write().overwrite().save(path)
    return path


def log_run(
    spark: SparkSession,
    path: str,
    name: str,
    metrics: Mapping[str, float],
    params: Mapping[str, object],
    seconds: float,
    at: datetime,
) -> DataFrame:
    """Write one run as its own partition of the run table at ``path`` and return it.

    Equal runs at the same time get the same id, so a retried run replaces what the failed try left.
    """
    row = spark.createDataFrame(
        [("", name, dict(metrics), {k: str(v) for k, v in params.items()}, float(seconds), at)], RUN_RECORD
    ).withColumn("run_id", run_id(F.col("model_name"), F.col("timestamp")))
    written = row.first()["run_id"]
    row.drop("run_id").write.mode("overwrite").parquet(f"{path}/run_id={written}")
    return row
