"""Lexicon scoring and stopword removal as joins on words."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.fixed_values import STOPWORDS
from wordtide.functions.keys import text_digest
from wordtide.functions.sentiment import sentiment_class, token_score
from wordtide.functions.text import space_split
from wordtide.schemas import LEXICON


def lexicon_table(spark: SparkSession, lexicon: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame(list(lexicon.items()), LEXICON)


def word_table(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], "word STRING")


def lexicon_score(posts: DataFrame, lexicon: Mapping[str, float] | DataFrame, hint: str | None = None) -> DataFrame:
    """Score and class of each row of ``posts``: the summed weights of its words, 0 where none is known.

    A mapping becomes part of the expression: no job, join or shuffle. A table of ``word`` and ``weight`` is joined;
    Spark broadcasts it while its statistics say that it is small, and otherwise splits words that hold much of the
    text. Both give the same rows: the score is a whole number if all weights are, a word listed twice has both
    weights, a NULL weight counts nothing, and rows that repeat an id are scored one by one. ``hint`` names a join
    strategy.
    """
    if isinstance(lexicon, Mapping):
        known = {w: n for w, n in lexicon.items() if n is not None}
        whole = all(isinstance(n, int) for n in known.values())
        score = F.coalesce(token_score(F.col("text"), known), F.lit(0)).cast("bigint" if whole else "double")
        scores = posts.select("id", score.alias("score"))
    else:
        whole = dict(lexicon.dtypes)["weight"] in ("tinyint", "smallint", "int", "bigint")
        weights = lexicon.groupBy("word").agg(F.sum("weight").cast("bigint" if whole else "double").alias("weight"))
        rows = posts.select("id", *text_digest("text"), "text")
        words = rows.select("id", "t1", "t2", F.posexplode_outer(space_split(F.col("text"))).alias("pos", "word"))
        # Word rows of one post are next to each other, so they are folded back before they are shuffled.
        weighed = words.join(weights.hint(hint) if hint else weights, "word", "left")
        zero = F.lit(0).cast("bigint" if whole else "double")
        # Rows are told apart by id and text, which a repeated task can't change; equal rows are counted and scored alike.
        copies = F.count_if(F.coalesce("pos", F.lit(0)) == 0)
        total = F.sum(F.coalesce("weight", zero))
        scores = weighed.groupBy("id", "t1", "t2").agg(total.alias("total"), copies.alias("copies"))
        score = F.expr("total div copies") if whole else F.col("total") / F.col("copies")
        scores = scores.select("id", score.alias("score"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")
    return scores.withColumn("sentiment", sentiment_class(F.col("score")))


def remove_stopwords(tokens: DataFrame, stopwords: Iterable[str] = STOPWORDS) -> DataFrame:
    """Rows of ``tokens`` whose ``token`` is not a stopword; positions and repeats are kept."""
    table = word_table(tokens.sparkSession, stopwords).withColumnRenamed("word", "token")
    return tokens.join(table, "token", "left_anti")
