"""Scores and classes from small word lists, as native expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordtide.fixed_values import (
    CONFIDENCE_WORDS,
    EVENT_SENTIMENT,
    KEYWORD_CONFIDENCE,
    KEYWORDS,
    NEGATIVE,
    NEUTRAL,
    POLARITY_NEGATIVE,
    POLARITY_POSITIVE,
    POSITIVE,
    STREAM_LEXICON,
    TOKEN_LEXICON,
)
from wordtide.functions.text import space_split


def sentiment_class(score: Column) -> Column:
    """Class by sign; an unknown score has no class."""
    return F.when(score > 0, POSITIVE).when(score < 0, NEGATIVE).when(score == 0, NEUTRAL)


def token_score(text: Column, lexicon: Mapping[str, float] = TOKEN_LEXICON) -> Column:
    """Sum of the weights of the words of ``text``; repeats count, unknown words count 0.

    The lexicon becomes one hash lookup per distinct weight inside the expression: no join, no shuffle.
    """
    zero = F.lit(0) if all(isinstance(n, int) for n in lexicon.values()) else F.lit(0.0)
    by_weight: dict[float, list[str]] = {}
    for word, weight in lexicon.items():
        by_weight.setdefault(weight, []).append(word)

    def weigh(word: Column) -> Column:
        return reduce(
            lambda rest, item: F.when(word.isin(*item[1]), F.lit(item[0])).otherwise(rest),
            by_weight.items(),
            zero,
        )

    # Few words are known, so they are picked by one lookup each before any weighing.
    hits = F.filter(space_split(text), lambda word: word.isin(*lexicon))
    return F.aggregate(hits, zero, lambda total, word: total + weigh(word))


def substring_score(text: Column, lexicon: Mapping[str, int] = STREAM_LEXICON) -> Column:
    """Sum of the weights of the words that occur anywhere in ``text``, each counted once."""
    lowered = F.lower(text)
    return reduce(
        add, (F.when(F.contains(lowered, F.lit(w)), n).otherwise(0) for w, n in lexicon.items())
    ) + F.when(text.isNull(), None).otherwise(0)


def count_contained(text: Column, words: Sequence[str]) -> Column:
    lowered = F.lower(text)
    return reduce(add, (F.contains(lowered, F.lit(w)).cast("int") for w in words))


def keyword_predict(text: Column) -> Column:
    """Struct of class and constant confidence; positive when any keyword is contained."""
    hit = count_contained(text, KEYWORDS) > 0
    return F.struct(
        F.when(hit, POSITIVE).otherwise(NEGATIVE).alias("sentiment"),
        F.lit(KEYWORD_CONFIDENCE).alias("confidence"),
    )


def confidence_predict(text: Column) -> Column:
    """Struct of class and confidence: a half, plus a tenth for each positive word contained.

    Counted in whole tenths, so no rounding error builds up. Several hits can pass 1.0.
    """
    hits = count_contained(text, CONFIDENCE_WORDS)
    return F.struct(
        F.when(hits > 0, POSITIVE).otherwise(NEGATIVE).alias("sentiment"),
        ((hits + 5) / F.lit(10.0)).alias("confidence"),
    )


def binary_label(polarity: Column) -> Column:
    return F.when(polarity == POLARITY_POSITIVE, 1).otherwise(0)


def polarity_class(polarity: Column) -> Column:
    return F.when(polarity == POLARITY_POSITIVE, POSITIVE).when(polarity == POLARITY_NEGATIVE, NEGATIVE)


def event_class(event_type: Column) -> Column:
    """Class of an event type; unknown types are neutral."""
    chain = F
    for name, sentiment in EVENT_SENTIMENT.items():
        chain = chain.when(event_type == name, sentiment)
    return chain.otherwise(NEUTRAL)
