"""From raw posts to tokens and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.fixed_values import POLARITY_NEGATIVE, POLARITY_POSITIVE
from wordtide.functions.sentiment import binary_label
from wordtide.functions.text import join_tokens, stem, tokenize, with_clean_text


def valid_posts(posts: DataFrame) -> DataFrame:
    """Posts with text and a known polarity."""
    return posts.where(
        F.col("text").isNotNull()
        & F.col("polarity").isin(POLARITY_NEGATIVE, POLARITY_POSITIVE)
        & (F.length("text") > 0)
    )


def with_tokens(posts: DataFrame) -> DataFrame:
    return with_clean_text(posts).withColumn("tokens", tokenize(F.col("cleaned_text")))


def with_stems(posts: DataFrame) -> DataFrame:
    """Adds ``cleaned_text``, ``stemmed_tokens`` and ``processed_text``."""
    return (
        with_tokens(posts)
        .withColumn("stemmed_tokens", stem(F.col("tokens")))
        .drop("tokens")
        .withColumn("processed_text", join_tokens(F.col("stemmed_tokens")))
    )


def preprocess(posts: DataFrame) -> DataFrame:
    """The preprocessed table: valid posts with cleaned text, stems and binary label."""
    return with_stems(valid_posts(posts)).withColumn("label", binary_label(F.col("polarity")))
