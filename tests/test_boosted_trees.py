"""Boosted trees over sparse rows against Spark ML's."""

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from wordtide.operators import models
from wordtide.operators.boosted_trees import Bins, SparseGBTClassifier, SparseGBTModel, sparse_parts, thresholds_of

COLUMNS = {"featuresCol": "x", "labelCol": "label"}


def sparse_rows(spark, n, width, dense=False, seed=3):
    random = np.random.default_rng(seed)
    held = np.where(random.random((n, 12)) < 0.4, random.integers(-1, 4, (n, 12)) * 0.7, 0.0)
    label = (held[:, 1] + 2 * held[:, 3] - held[:, 5] * held[:, 7] + random.normal(0, 0.5, n) > 0.6).astype(int)
    places = [int(k) for k in np.linspace(0, width - 1, 12)]
    vector = lambda r: Vectors.dense(r) if dense else Vectors.sparse(width, [(p, float(v)) for p, v in zip(places, r) if v])
    return spark.createDataFrame([(i, int(y), vector(r)) for i, (y, r) in enumerate(zip(label, held))], ["id", "label", "x"])


@pytest.mark.parametrize("dense", [False, True])
def test_trees_are_those_of_spark_ml(spark, dense):
    """Deeper nodes are small and have splits of equal gain, which rounding orders."""
    df = sparse_rows(spark, 600, 12 if dense else 40, dense)
    want = GBTClassifier(maxIter=6, maxDepth=3, seed=1, **COLUMNS).fit(df).transform(df)
    got = SparseGBTClassifier(maxIter=6, maxDepth=3, seed=1, **COLUMNS).fit(df).transform(df)
    assert got.columns == want.columns
    both = {r.id: r for r in want.collect()}
    for r in got.collect():
        assert r.prediction == both[r.id].prediction
        assert r.rawPrediction.toArray() == pytest.approx(both[r.id].rawPrediction.toArray())
        assert r.probability.toArray() == pytest.approx(both[r.id].probability.toArray())


def test_work_follows_the_values_and_not_the_width(spark):
    """Sixteen million features, of which twelve hold values: dense rows would take gigabytes."""
    df = sparse_rows(spark, 600, 1 << 24).withColumnRenamed("x", models.TFIDF)
    narrow = sparse_rows(spark, 600, 40).withColumnRenamed("x", models.TFIDF)
    wide = models.fit("Gradient-Boosted Trees", df).transform(df)
    assert rows(wide, "id", "prediction") == rows(models.fit("Gradient-Boosted Trees", narrow).transform(narrow), "id", "prediction")


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.createDataFrame([(Vectors.dense([i / 7.0, 1.0]),) for i in range(1, 1001)], ["x"])
    found = thresholds_of(df.select(*sparse_parts("x")), 1000, 32)
    # The second feature has one value.
    assert set(found["f"]) == {0} and len(found) == 31
    shares = np.diff([0, *(found["t"] * 7).tolist(), 1000.5])
    assert shares.min() > 30 and shares.max() < 33
    bins = Bins(found)
    at, has = bins.of(np.array([0, 0, 1]), np.array([0.0, 500.0, 1.0]))
    assert at.tolist() == [0, 31] and has.tolist() == [True, True, False]


def test_models_are_saved_and_tuned(spark, tmp_path):
    df = sparse_rows(spark, 300, 40)
    model = SparseGBTClassifier(maxIter=2, **COLUMNS).fit(df)
    again = SparseGBTModel.load(models.save_model(model, str(tmp_path), "Gradient-Boosted Trees"))
    assert rows(again.transform(df), "id", "rawPrediction") == rows(model.transform(df), "id", "rawPrediction")
    best, _, scores = models.cross_validate("Gradient-Boosted Trees", df.withColumnRenamed("x", models.TFIDF), folds=2)
    assert isinstance(best, SparseGBTModel) and 0 < scores[0] <= 1


def test_odd_rows(spark):
    alike = spark.createDataFrame([(1, Vectors.sparse(9, [], []))] * 3 + [(0, Vectors.sparse(9, [], []))], ["label", "x"])
    assert {r.prediction for r in SparseGBTClassifier(**COLUMNS).fit(alike).transform(alike).collect()} == {1.0}
    for label in (2, None):
        with pytest.raises(ValueError, match="label"):
            SparseGBTClassifier(**COLUMNS).fit(alike.withColumn("label", F.lit(label).cast("int")))
