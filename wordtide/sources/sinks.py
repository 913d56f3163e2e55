"""Writing results. Executors write; the driver never holds the rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.sources import manifest


def write_table(df: DataFrame, target: str, mode: str = "overwrite", fmt: str = "parquet", *partition_by: str, **options):
    """Write to a path, or with ``fmt`` and ``options`` to any connector that is installed.

    For a document store, give the format of its connector and its database and collection as options; ``target``
    is then passed as the path option as well, which such connectors ignore.
    """
    df.write.format(fmt).mode(mode).options(**options).partitionBy(*partition_by).save(target)


def write_preprocessed(preprocessed: DataFrame, path: str) -> None:
    """The preprocessed table, partitioned by label; a rerun replaces the whole table."""
    columns = ["id", "date", "polarity", "label", "text", "cleaned_text", "processed_text", "stemmed_tokens"]
    preprocessed.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "label"
    ).parquet(path)


def published_predictions(predictions: DataFrame, model_name: str, at: datetime) -> DataFrame:
    """Predictions in the shape they are served in."""
    return predictions.select(
        "id",
        "text",
        F.col("label").cast("int").alias("actual_label"),
        F.col("prediction").cast("int").alias("predicted_label"),
        vector_to_array("rawPrediction").alias("raw_scores"),
        F.lit(model_name).alias("model_name"),
        F.lit(at).alias("timestamp"),
    )


def publish(spark: SparkSession, base: str, fmt: str = "parquet", **tables: DataFrame) -> dict[str, str]:
    """Replace the set of tables published below ``base``, one per keyword, in one step. Returns their paths.

    Every table is written to a new folder; then one manifest makes all of them the published set. Until then, and if a
    table fails, readers get the old set. Of two writers at once, the one that comes second is published last.
    """
    folders = {name: manifest.new_folder(base) for name in tables}
    for name, df in tables.items():
        write_table(df, f"{base}/{folders[name]}", "errorifexists", fmt)
    state = {"folders": list(folders.values()), "tables": folders, "format": fmt}
    while True:
        try:
            manifest.commit(spark, base, manifest.latest(spark, base)[0], state)
            return {name: f"{base}/{folder}" for name, folder in folders.items()}
        except manifest.Taken:
            continue


def published(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables of the newest published set, all of one commit; empty before the first."""
    state = manifest.latest(spark, base)[1]
    return {name: spark.read.format(state["format"]).load(f"{base}/{folder}") for name, folder in state.get("tables", {}).items()}


def content_checksum(df: DataFrame) -> list:
    """Aggregates that two tables share if they hold the same rows, in any order and as often: rows, and two sums.

    Each row gives two 64-bit hashes with different seeds, of all its values and of which of them are NULL, as a hash
    alone passes over NULLs. The sums are decimals and can't overflow. Columns of maps are hashed as JSON.
    """
    values = [F.to_json(c) if kind.startswith("map") else F.col(c) for c, kind in ((f"`{n}`", k) for n, k in df.dtypes)]
    missing = [F.col(f"`{n}`").isNull() for n in df.columns]
    sums = [F.sum(F.xxhash64(F.lit(seed), *values, *missing).cast("decimal(38,0)")) for seed in ("first", "second")]
    return [F.count("*").alias("n"), *(F.coalesce(s, F.lit(0).cast("decimal(38,0)")).alias(f"sum{i}") for i, s in enumerate(sums, 1))]


def land_verified(spark: SparkSession, df: DataFrame, zone: str, name: str) -> DataFrame:
    """Copy a table to the raw zone and compare content, not only counts: one row of table, n, landed and same."""
    target = f"{zone}/raw/{name}"
    df.write.mode("overwrite").parquet(target)
    landed = spark.read.schema(df.schema).parquet(target)
    both = df.agg(F.struct(*content_checksum(df)).alias("sent")).withColumn("landed", landed.agg(F.struct(*content_checksum(landed))).scalar())
    return both.select(F.lit(name).alias("table"), F.col("sent.n").alias("n"), F.col("landed.n").alias("landed"), (F.col("sent") == F.col("landed")).alias("same"))


def land_raw(spark: SparkSession, df: DataFrame, zone: str, name: str) -> DataFrame:
    """Copy a table to the raw zone and return one row with its name, rows read and rows landed."""
    target = f"{zone}/raw/{name}"
    df.write.mode("overwrite").parquet(target)
    landed = spark.read.schema(df.schema).parquet(target).agg(F.count("*").alias("landed"))
    return df.agg(F.lit(name).alias("table"), F.count("*").alias("n")).withColumn("landed", landed.scalar())
