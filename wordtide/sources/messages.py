"""JSON messages: generating, encoding, parsing; and generated multi-source feeds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.fixed_values import (
    FEED_SOURCES,
    MESSAGE_TEXTS,
    MESSAGE_TIME_FORMAT,
    POLARITY_NEGATIVE,
    POLARITY_POSITIVE,
)
from wordtide.schemas import MESSAGE


def message_text(number: Column) -> Column:
    """One of the message texts, picked by a running number."""
    texts = F.array(*(F.lit(t) for t in MESSAGE_TEXTS))
    return F.get(texts, F.pmod(number, F.lit(len(MESSAGE_TEXTS))).cast("int"))


def as_messages(numbers: DataFrame, number: str, user: Column, ts: Column) -> DataFrame:
    """The columns of ``numbers`` plus the message fields text, user, timestamp."""
    return numbers.select(
        "*",
        message_text(F.col(number)).alias("text"),
        F.concat(F.lit("user_"), user.cast("string")).alias("user"),
        F.date_format(ts, MESSAGE_TIME_FORMAT).alias("timestamp"),
    )


def synthetic_messages(spark: SparkSession, n: int, at: Column | None = None) -> DataFrame:
    """``n`` messages of a hundred users, made on the executors."""
    at = F.current_timestamp() if at is None else at
    numbers = as_messages(spark.range(n), "id", F.pmod(F.xxhash64("id"), F.lit(100)) + 1, at)
    return numbers.select("text", "user", "timestamp")


def encode(df: DataFrame, *fields: str) -> DataFrame:
    """Rows as binary JSON in ``value``, the shape a message queue holds."""
    return df.select(F.to_json(F.struct(*fields)).cast("binary").alias("value"))


def parse(messages: DataFrame, schema: str = MESSAGE) -> DataFrame:
    """Typed fields of binary JSON; what does not parse becomes NULL."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def feed(df: DataFrame, source: str, number: str) -> DataFrame:
    """Generated posts, one per row: numbered id and text per source, polarity alternating by number."""
    src, n = F.col(source), F.col(number)
    return df.select(
        F.when(n % 2 == 0, POLARITY_POSITIVE).otherwise(POLARITY_NEGATIVE).alias("polarity"),
        src.alias("source"),
        F.format_string("tweet from %s #%d", src, n).alias("text"),
        F.concat_ws("_", src, n.cast("string")).alias("id"),
    )


def synthetic_feed(spark: SparkSession, sizes: Mapping[str, int] = FEED_SOURCES) -> DataFrame:
    """Generated posts of several sources, numbered from 0 in each. Rows are made on the executors."""
    frames = [feed(spark.range(n).withColumn("source", F.lit(name)), "source", "id") for name, n in sizes.items()]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked
