"""Parquet tables and the ``posts`` view over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.fixed_values import POLARITY_NEGATIVE, POLARITY_POSITIVE
from wordtide.functions.sentiment import event_class
from wordtide.schemas import TABLES


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a bare scan that has fewer splits than the cluster has cores, so that costly text work uses all of them.

    A small table is one file and would be one task. A large one has more splits than cores and is left alone. Only for
    scans and columns of them: counting the splits of a join would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with string ids: id, text, source."""
    docs = read_table(spark, folder, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("id"), "text", "source")


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a polarity where they are labelled: id, text, source, polarity.

    Spark broadcasts the labels while they are small, by its size statistics, and otherwise sorts and merges both
    sides on the key.
    """
    return with_polarity(spark, folder, read_table(spark, folder, "documents").select("doc_id", "text", "source"))


def with_polarity(spark: SparkSession, folder: str, docs: DataFrame) -> DataFrame:
    """``docs`` with their polarity, and their doc_id as text ``id``.

    What is computed from a text should be computed before, so that the join moves results and not texts.
    """
    labels = read_table(spark, folder, "labels").select("doc_id", "toxic")
    polarity = F.when(F.col("toxic") == 0, POLARITY_POSITIVE).when(F.col("toxic") == 1, POLARITY_NEGATIVE)
    others = [c for c in docs.columns if c != "doc_id"]
    return docs.join(labels, "doc_id", "left").select(F.col("doc_id").cast("string").alias("id"), *others, polarity.alias("polarity"))


def scored_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as scored messages: event_id, ts, event_type, sentiment."""
    events = read_table(spark, folder, "events")
    return events.select("event_id", "ts", "event_type", event_class(F.col("event_type")).alias("sentiment"))


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """Stack frames under a ``source`` column; columns that a frame lacks are NULL."""
    stacked = None
    for name, frame in frames.items():
        named = frame.withColumn("source", F.lit(name))
        stacked = named if stacked is None else stacked.unionByName(named, allowMissingColumns=True)
    if stacked is None:
        raise ValueError("no sources given")
    return stacked
