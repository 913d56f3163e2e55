"""The batch job: posts to preprocessed table, features, tuned models and published tables.

``python -m wordtide.plans.batch --posts <csv> --out <folder>`` or, from code, ``run``.
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.fixed_values import CV_FOLDS, PIPELINE
from wordtide.functions.keys import in_sample, split_name
from wordtide.operators import evaluation, features, models, reports
from wordtide.operators.preprocess import preprocess
from wordtide.schemas import MODEL_METRICS, PREPROCESSED
from wordtide.session import build_session, configure
from wordtide.sources.posts_csv import read_posts
from wordtide.sources.sinks import publish, published_predictions, write_preprocessed, write_table

MODEL_FIELDS = [column.split()[0] for column in MODEL_METRICS.split(", ")]


def write_features(spark: SparkSession, out: str, **settings) -> tuple[DataFrame, DataFrame]:
    """Split the preprocessed table by id, fit the features on the training side, write both sides."""
    posts = spark.read.schema(PREPROCESSED).parquet(f"{out}/preprocessed")
    sides = {name: posts.where(split_name(F.col("id")) == name) for name in ("train", "test")}
    model = features.feature_model(sides["train"], features.word2vec_tasks(sides["train"], "stemmed_tokens"), **settings)
    written = []
    for name, side in sides.items():
        columns = model.transform(side).select(*features.FEATURE_COLUMNS)
        columns.write.mode("overwrite").parquet(f"{out}/features_{name}")
        written.append(spark.read.schema(columns.schema).parquet(f"{out}/features_{name}"))
    return tuple(written)


def train_model(name: str, train: DataFrame, test: DataFrame, out: str, at: datetime) -> tuple[dict, DataFrame]:
    """Tune one model, save it, write its test predictions, log the run, and return its metrics and predictions."""
    spark = train.sparkSession
    model, seconds, _ = models.cross_validate(name, train)
    models.save_model(model, f"{out}/models", name)

    path = f"{out}/predictions/{models.model_slug(name)}"
    scored = model.transform(test).select("id", "text", "label", "prediction", "rawPrediction")
    write_table(scored, path)
    written = spark.read.schema(scored.schema).parquet(path)

    metrics = evaluation.classification_metrics(written).first().asDict()
    raw = written.select("label", F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("score"))
    metrics["auc"] = evaluation.auc_roc(raw, digits=4).first()["auc"]
    tried = {p.name: model.getOrDefault(p) for p in model.params if p.name in models.MODELS[name][2]}
    models.log_run(spark, f"{out}/runs", name, metrics, tried, seconds, at)
    return {"model_name": name, "train_time_sec": seconds, **metrics}, written


def run(
    spark: SparkSession,
    posts: DataFrame,
    out: str,
    at: datetime,
    names: list[str] | None = None,
    train_fraction: float = 1.0,
    **settings,
) -> dict[str, str]:
    """The whole job. Returns the paths of the published tables.

    ``train_fraction`` draws a repeatable sample of the rows that are fitted, for trial runs on small machines. What is
    predicted and published is always whole.
    """
    configure(spark)
    names = names or models.COMPARED
    write_preprocessed(preprocess(posts), f"{out}/preprocessed")
    train, test = write_features(spark, out, **settings)
    if train_fraction < 1:
        train = train.where(in_sample(F.col("id"), train_fraction))

    results = [train_model(name, train, test, out, at) for name in names]
    rows = [{"position": i, **result} for i, (result, _) in enumerate(results)]
    metrics = spark.createDataFrame([tuple(r[f] for f in MODEL_FIELDS) for r in rows], MODEL_METRICS)
    best = max(rows, key=lambda r: r["f1"])["model_name"]

    kept = next(predictions for result, predictions in results if result["model_name"] == best)
    served = metrics.drop("position").withColumnsRenamed({"f1": "f1_score", "auc": "auc_roc"})
    served = served.withColumns({"is_best": F.col("model_name") == best, "timestamp": F.lit(at), "version": F.lit("1.0")})
    winner = reports.model_metadata(metrics, CV_FOLDS, models.estimator_of(best)[0].getFeaturesCol())
    return publish(
        spark,
        f"{out}/published",
        model_metrics=served,
        model_metadata=winner.withColumns({"timestamp": F.lit(at), "pipeline": F.lit(PIPELINE)}),
        batch_predictions=published_predictions(kept, best, at),
    )


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--posts", required=True, help="headerless CSV of posts")
    parser.add_argument("--out", required=True, help="folder for tables and models, shared by all executors")
    parser.add_argument("--encoding", default="UTF-8")
    parser.add_argument("--train-fraction", type=float, default=1.0)
    parser.add_argument("--multi-line", action="store_true", help="posts may hold line breaks; a file is then one task")
    args = parser.parse_args()
    spark = build_session("batch")
    run(
        spark,
        read_posts(spark, args.posts, args.encoding, multi_line=args.multi_line),
        args.out,
        datetime.now(),
        train_fraction=args.train_fraction,
    )


if __name__ == "__main__":
    main()
