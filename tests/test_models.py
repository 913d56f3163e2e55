"""Metrics, features and classifiers against Spark ML and brute force."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, NGram
from pyspark.sql import functions as F

from wordtide.functions.arrays import bigrams
from wordtide.operators import evaluation, features, models
from wordtide.plans import batch, queries
from wordtide.schemas import RUN_RECORD
from wordtide.sources.tables import posts


@pytest.fixture(scope="module")
def predictions(spark):
    """Scores with many ties, an imbalance of classes, and a prediction that is often wrong."""
    df = spark.range(2000).select(
        "id",
        (F.pmod(F.xxhash64("id"), F.lit(7)) < 2).cast("int").alias("label"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)) / 4.0).alias("noise"),
    )
    return df.withColumn("score", F.col("noise") + F.col("label") * 2).withColumn(
        "prediction", (F.col("score") > 6).cast("double")
    )


def test_metrics_equal_the_evaluators(predictions):
    got = evaluation.classification_metrics(predictions, digits=10).first()
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}
    for ours, theirs in names.items():
        assert got[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(predictions))


def test_metrics_of_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0), (1, 1.0)], "label INT, prediction DOUBLE")
    assert tuple(evaluation.classification_metrics(df).first()) == (0.6667, 0.4444, 0.6667, 0.5333)


@pytest.mark.parametrize("ranges", ["1", "2", "16"])
def test_auc_is_exact_for_any_number_of_ranges(spark, predictions, ranges):
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(predictions)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        assert evaluation.auc_roc(predictions).first()["auc"] == pytest.approx(want, abs=1e-6)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_auc_of_infinite_and_unknown_scores(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1, inf), (0, -inf), (1, 0.0), (0, 0.5), (1, nan), (0, nan), (0, None)], "label INT, score DOUBLE")
    # Of the four pairs of known scores, three are ranked right.
    assert evaluation.auc_roc(df).first()["auc"] == 0.75


def test_auc_of_continuous_and_missing_scores(spark):
    df = spark.range(3000).select((F.col("id") % 3 == 0).cast("int").alias("label"), F.rand(7).alias("score"))
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    unknown = spark.createDataFrame([(1, None)], "label INT, score DOUBLE")
    assert evaluation.auc_roc(df.union(unknown)).first()["auc"] == pytest.approx(want, abs=1e-6)
    one_class = df.where("label = 1")
    assert evaluation.auc_roc(one_class).first()["auc"] is None


@pytest.fixture(scope="module")
def stems(spark):
    from conftest import SMALL

    from wordtide.operators.preprocess import with_stems
    from wordtide.session import stage
    from wordtide.sources.tables import documents

    return stage(with_stems(documents(spark, SMALL)).select("id", "stemmed_tokens"), "test-stems")


def test_tfidf_equals_idf_model(stems):
    """Same weights as Spark ML when every term has a bucket of its own."""
    vectors = CountVectorizer(inputCol="stemmed_tokens", outputCol="tf", minDF=1.0).fit(stems)
    weighed = IDF(inputCol="tf", outputCol="w", minDocFreq=5)
    counted = vectors.transform(stems)
    vocabulary = vectors.vocabulary
    want = {}
    for row in weighed.fit(counted).transform(counted).select("id", "w").collect():
        for index, value in zip(row.w.indices, row.w.values):
            want[row.id, vocabulary[index]] = value
    got = {(r.id, r.term): r.tfidf for r in features.tfidf_terms(stems.withColumn("split", F.lit("train")), "stemmed_tokens").collect()}
    assert got.keys() == want.keys()
    assert all(v == pytest.approx(want[k], abs=1e-6) for k, v in got.items())


def test_bigrams_equal_ngram(stems):
    both = NGram(n=2, inputCol="stemmed_tokens", outputCol="theirs").transform(stems)
    assert both.where(F.col("theirs") != bigrams(F.col("stemmed_tokens"))).count() == 0


def test_bigram_vocabulary_equals_count_vectorizer(stems):
    model = Pipeline(stages=features.bigram_stages()).fit(stems)
    ours = features.bigram_vocabulary(stems, "stemmed_tokens").collect()
    assert {r.bigram for r in ours} == set(model.stages[1].vocabulary)
    assert [r.n for r in sorted(ours, key=lambda r: r["rank"])] == sorted((r.n for r in ours), reverse=True)


def test_sparse_arrays_hold_the_vector(spark, stems):
    hashed = features.tfidf_stages()[0].transform(stems)
    for row in hashed.select("raw_features", *features.sparse_arrays("raw_features")).limit(20).collect():
        assert row.raw_features.size == 50_000
        assert list(row.raw_features.indices) == row.raw_features_indices
        assert list(row.raw_features.values) == row.raw_features_values


def test_word2vec_vocabulary_check(stems, monkeypatch):
    n = features.check_word2vec_vocabulary(stems, "stemmed_tokens", 100, 5)
    assert n > 0
    monkeypatch.setattr(features, "WORD2VEC_MAX_FLOATS", n * 100 - 1)
    with pytest.raises(ValueError, match="too many"):
        features.check_word2vec_vocabulary(stems, "stemmed_tokens", 100, 5)


def test_word2vec_tasks_follow_cores_and_words(spark, stems, monkeypatch):
    assert features.word2vec_tasks(stems, "stemmed_tokens") == features.WORD2VEC_TASKS
    assert features.word2vec_tasks(stems.where("false"), "stemmed_tokens") == features.WORD2VEC_TASKS
    monkeypatch.setattr(features, "WORD2VEC_TASKS", 2)
    assert features.word2vec_tasks(stems, "stemmed_tokens") == 2
    monkeypatch.setattr(features, "WORD2VEC_TASK_WORDS", 1_000)
    assert features.word2vec_tasks(stems, "stemmed_tokens") == spark.sparkContext.defaultParallelism
    fitted = []
    monkeypatch.setattr(features.Word2Vec, "setNumPartitions", lambda self, n: fitted.append(n) or self._set(numPartitions=n))
    queries.featured(spark, "/root/testdata/sf0.001", lambda: [features.word2vec_stage()])
    assert fitted[-1] > 2


@pytest.mark.parametrize("name", ["Linear SVM", "Logistic Regression", "Naive Bayes", "Random Forest"])
def test_models_learn_and_reload(spark, name, tmp_path):
    """Each model does at least as well as the majority class on posts whose words give the label away."""
    df = spark.range(400).select(
        F.col("id").cast("string").alias("id"),
        (F.col("id") % 4 != 0).cast("int").alias("label"),
        F.concat(F.lit("word"), F.pmod(F.xxhash64("id"), F.lit(9)).cast("string")).alias("w"),
    )
    mood = F.when(F.col("label") == 1, "kind").otherwise("mean")
    posts = df.withColumn("stemmed_tokens", F.array(F.col("w"), mood))
    train, test = posts.where("id % 5 <> 0"), posts.where("id % 5 = 0")
    pipeline = Pipeline(stages=features.tfidf_stages(buckets=64)).fit(train)
    model = models.fit(name, pipeline.transform(train))
    scored = model.transform(pipeline.transform(test))
    majority = evaluation.classification_metrics(test.withColumn("prediction", F.lit(1.0))).first()["f1"]
    assert evaluation.classification_metrics(scored).first()["f1"] > majority

    again = type(model).load(models.save_model(model, str(tmp_path), name))
    before = rows(scored.select("id", "prediction"))
    assert rows(again.transform(pipeline.transform(test)).select("id", "prediction")) == before


def test_batch_job_publishes_whole_tables(spark, small, tmp_path):
    out, at = str(tmp_path), datetime(2024, 1, 2, 3, 4, 5)
    source = posts(spark, small).withColumn("date", F.lit(None).cast("string"))
    settings = {"buckets": 512, "min_doc_freq": 1, "min_count": 2, "min_docs": 2}
    paths = batch.run(spark, source, out, at, names=["Linear SVM", "Random Forest"], **settings)

    metrics = spark.read.parquet(paths["model_metrics"]).orderBy("model_name").collect()
    assert [m.model_name for m in metrics] == ["Linear SVM", "Random Forest"]
    assert sum(m.is_best for m in metrics) == 1
    best = max(metrics, key=lambda m: m.f1_score)
    meta = spark.read.parquet(paths["model_metadata"]).first()
    assert (meta.best_model, meta.best_f1, meta.total_models_trained) == (best.model_name, best.f1_score, 2)
    assert metrics[0].asDict().keys() == {
        "model_name", "accuracy", "precision", "recall", "f1_score", "auc_roc", "train_time_sec", "is_best", "timestamp", "version",
    }
    assert meta.asDict().keys() == {
        "best_model", "best_f1", "best_accuracy", "total_models_trained", "cv_folds", "feature_column", "version", "timestamp", "pipeline",
    }

    served = spark.read.parquet(paths["batch_predictions"])
    tested = spark.read.parquet(f"{out}/features_test")
    assert rows(served.select("id")) == rows(tested.select("id"))
    runs = spark.read.schema(RUN_RECORD).parquet(f"{out}/runs")
    assert {r.run_id for r in runs.collect()} == {"Linear SVM_20240102_030405", "Random Forest_20240102_030405"}
    assert all(set(r.metrics) == {"accuracy", "precision", "recall", "f1", "auc"} for r in runs.collect())


def test_batch_job_takes_the_perceptron_s_width_from_the_vectors(spark, small, tmp_path):
    source = posts(spark, small).withColumn("date", F.lit(None).cast("string"))
    settings = {"buckets": 512, "min_doc_freq": 1, "min_count": 2, "min_docs": 2, "size": 50}
    paths = batch.run(spark, source, str(tmp_path), datetime(2024, 1, 2), names=["MLP"], **settings)
    assert spark.read.parquet(paths["model_metadata"]).first().best_model == "MLP"


def test_a_run_logged_twice_is_one_run(spark, tmp_path):
    for _ in range(2):
        models.log_run(spark, str(tmp_path), "M", {"f1": 0.5}, {"a": 1}, 2.0, datetime(2024, 1, 2))
    assert spark.read.schema(RUN_RECORD).parquet(str(tmp_path)).count() == 1


@pytest.mark.parametrize("name", ["Random Forest", "Linear SVM", "Logistic Regression", "Naive Bayes", "Gradient-Boosted Trees", "MLP"])
def test_every_model_beats_the_majority_on_separable_rows(spark, name):
    from pyspark.ml.feature import VectorAssembler

    base = spark.range(120).select((F.col("id") % 3 == 0).cast("int").alias("label"), (F.col("id") % 7 * 0.1).alias("x"))
    wide = base.select("label", F.col("x"), (F.col("label") * 2.0 + F.col("x")).alias("y"))
    features_ = models.WORD2VEC if name == "MLP" else models.TFIDF
    df = VectorAssembler(inputCols=["x", "y"], outputCol=features_).transform(wide)
    got = models.fit(name, df).transform(df)
    assert got.where("label = prediction").count() > 90


def test_word_vectors_are_whole(spark, small):
    first, second = (rows(queries.QUERIES["word2vec"](spark, small)) for _ in range(2))
    assert [r[:2] for r in first] == [r[:2] for r in second]
    assert all(len(v) == 100 and None not in v for _, _, v in first)


def test_word_vectors_of_features_stay_off_the_driver(spark, stems, tmp_path):
    """The fitted stage holds a path and no vectors, gives each row its mean whatever its id, and can be saved."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    model = Pipeline(stages=[features.word2vec_stage(size=8)]).fit(stems)
    assert not hasattr(model.stages[0], "_java_obj")
    held = {r.word: r.vector for r in model.stages[0].getVectors().collect()}
    assert len(held) == features.check_word2vec_vocabulary(stems, "stemmed_tokens", 8, 5)
    some = list(held)[:2]
    odd = spark.createDataFrame([("1", [some[0]]), ("1", [some[1], some[1], "unknown word"]), (None, some), ("2", [])], "id STRING, stemmed_tokens ARRAY<STRING>")
    got = rows(model.transform(odd).select("id", "stemmed_tokens", vector_to_array("word2vec_features")))
    means = [[0.0] * 8, held[some[0]], held[some[1]], [(a + b) / 2 for a, b in zip(held[some[0]], held[some[1]])]]
    assert len(got) == 4 and all(any(max(abs(x - y) for x, y in zip(r[2], m)) < 1e-9 for r in got) for m in means)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(odd)
    assert rows(again.select("id", "stemmed_tokens", vector_to_array("word2vec_features"))) == got
