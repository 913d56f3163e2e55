"""Word counts and corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordtide.fixed_values import POLARITY_NEGATIVE, POLARITY_POSITIVE
from wordtide.functions.arrays import explode_words
from wordtide.functions.text import WORD_RULES


def words_of(posts: DataFrame, rule: str, *keep: str) -> DataFrame:
    """One row per word of ``text`` under a word rule, with the ``keep`` columns."""
    return explode_words(posts, WORD_RULES[rule](F.col("text")), *keep)


def count_words(words: DataFrame, *by: str) -> DataFrame:
    """Occurrences per word. Counting starts before the shuffle, so a frequent word costs one row per task."""
    return words.groupBy(*by, "word").agg(F.count("*").alias("n"))


def word_count(posts: DataFrame, rule: str) -> DataFrame:
    return count_words(words_of(posts, rule))


def top_words(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent words, ties by word. Ranks are given to the ``k`` rows that remain."""
    order = [F.desc("n"), F.asc("word")]
    return counts.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_words_by(counts: DataFrame, k: int, by: str) -> DataFrame:
    """The ``k`` most frequent words of each group.

    Each task keeps its own best ``k`` per group before the shuffle (a window group limit), so a
    group receives few rows however many words it has.
    """
    order = Window.partitionBy(by).orderBy(F.desc("n"), F.asc("word"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def unique_words(posts: DataFrame, rule: str = "letters") -> DataFrame:
    return word_count(posts, rule).agg(F.count("*").alias("unique_words"))


def unique_words_approx(posts: DataFrame, rule: str = "letters", rsd: float = 0.02) -> DataFrame:
    """Estimated number of words from one sketch per task."""
    return words_of(posts, rule).agg(F.approx_count_distinct("word", rsd).alias("unique_words"))


# log2 of a sketch's cells: 16,384 cells have a standard error of under one percent and take some 16 KB.
SKETCH_CELLS = 14


def word_sketches(posts: DataFrame, *by: str, rule: str = "letters") -> DataFrame:
    """One sketch of the distinct words of each group, as binary ``sketch``, to be stored and merged later."""
    return words_of(posts, rule, *by).groupBy(*by).agg(F.hll_sketch_agg("word", SKETCH_CELLS).alias("sketch"))


def merge_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of larger groups, or of all rows: what a sketch of the words themselves would be, without the words."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_words(sketches: DataFrame) -> DataFrame:
    """``sketch`` replaced by the estimated number of distinct words."""
    return sketches.withColumn("unique_words", F.hll_sketch_estimate("sketch")).drop("sketch")


def corpus_stats(texts: DataFrame, posts: DataFrame, rule: str = "letters") -> DataFrame:
    """Records, words, distinct words, words per record and class counts.

    Words come from the word counts of ``texts``; records and classes from ``posts``, which need no text.
    """
    word_totals = word_count(texts, rule).agg(
        F.struct(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct"))
    )
    records = posts.agg(
        F.count("*").alias("records"),
        F.count_if(F.col("polarity") == POLARITY_POSITIVE).alias("positive"),
        F.count_if(F.col("polarity") == POLARITY_NEGATIVE).alias("negative"),
    )
    return records.withColumn("words", word_totals.scalar()).select(
        "records",
        F.col("words.total").alias("total_words"),
        F.col("words.distinct").alias("unique_words"),
        F.round(F.try_divide("words.total", "records"), 6).alias("avg_words"),
        "positive",
        "negative",
    )


def count_by(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))
