"""Transformations of message streams. They work on batch frames too."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.fixed_values import STREAM_LEXICON
from wordtide.functions.sentiment import sentiment_class, substring_score
from wordtide.sources.messages import parse


def score_messages(messages: DataFrame, lexicon: Mapping[str, int] = STREAM_LEXICON) -> DataFrame:
    """Adds ``score`` and ``sentiment``. A message without text gets neither and is not lost."""
    return messages.withColumn("score", substring_score(F.col("text"), lexicon)).withColumn(
        "sentiment", sentiment_class(F.col("score"))
    )


def parse_and_score(raw: DataFrame, schema: str, lexicon: Mapping[str, int] = STREAM_LEXICON) -> DataFrame:
    return score_messages(parse(raw, schema), lexicon)


def trend(scored: DataFrame, ts: str, window: str, slide: str | None = None) -> DataFrame:
    """Messages per time window and class, of a batch. Over a stream, the merging sink adds the batches up."""
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    counted = scored.groupBy(span.alias("window"), "sentiment").agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), "sentiment", "n")


def drop_repeats(messages: DataFrame, key: str, ts: str | None = None, delay: str | None = None) -> DataFrame:
    """One message per key.

    With ``ts`` and ``delay``, keys are forgotten when the watermark passes, and only repeats that arrive within
    ``delay`` of each other are found; messages that are later than that are dropped. Without, every key is kept.
    """
    if delay is None:
        return messages.dropDuplicates([key])
    return messages.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
