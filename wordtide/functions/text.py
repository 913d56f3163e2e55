"""Cleaning, tokenizing and stemming.

Patterns spell out Unicode whitespace and word characters because plain Java ``\\s`` and ``\\w`` are
ASCII only, while posts hold accented words and non-breaking spaces.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wordtide.fixed_values import STOPWORDS, SUFFIX_RULES

SPACE = r"\p{IsWhite_Space}\x1c-\x1f"
# The ASCII ranges are part of the classes they stand in. They are tried first and save the slow lookup of
# Unicode properties for most characters.
NON_SPACE = f"[!-~[^{SPACE}]]"
LETTER = r"[a-zA-Z\p{L}]"
WORD_CHAR = r"[\p{L}\p{N}_]"

# Characters that compatibility normalization can neither turn into ASCII letters nor merge with a
# neighbour: Latin letters with accents and Latin-1 signs (without the ordinals and the ligature-like
# letters), Cyrillic letters, general punctuation, the euro sign, CJK ideographs.
# Text made of these and ASCII needs no normalization, so it is never sent to Python.
INERT = (
    r"\u00A0-\u00A9\u00AB-\u00B9\u00BB-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u017E"
    r"\u0400-\u0482\u048A-\u04FF\u2010-\u2027\u20AC\u4E00-\u9FFF"
)


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, rf"http{NON_SPACE}+|www\.{NON_SPACE}+", "")


def strip_mentions(text: Column) -> Column:
    return F.regexp_replace(text, f"@{WORD_CHAR}+", "")


def strip_hashtag_marks(text: Column) -> Column:
    """Drop the mark and keep the word, which joins whatever stands before the mark."""
    return F.regexp_replace(text, f"#(?={WORD_CHAR})", "")


def squeeze_runs(text: Column) -> Column:
    """Shorten runs of three or more equal characters to two."""
    return F.regexp_replace(text, r"(.)\1{2,}", "$1$1")


def letters_only(text: Column) -> Column:
    """Lower-cased ASCII words joined by single spaces; everything else separates.

    Splitting and joining takes a fraction of the time of replacing: nearly every word ends in a match.
    """
    return F.trim(F.lower(F.array_join(F.split(text, "[^a-zA-Z]+"), " ")))


def normalize_nfkc(text: Column) -> Column:
    """Compatibility-normalize the texts that it can change; other rows reach Python as NULL."""

    # An inner function travels to the workers by value, so they need not have this package.
    def nfkc(batch: pd.Series) -> pd.Series:
        return batch.str.normalize("NFKC")

    # ASCII text shows by its length in bytes. In other text the pattern first looks for a non-ASCII character, which
    # is rare, and only then tries the long class on it.
    open_to_change = (F.octet_length(text) > F.length(text)) & text.rlike(rf"[^\x00-\x7F](?<![{INERT}])")
    normalized = F.pandas_udf(nfkc, StringType())(F.when(open_to_change, text))
    return F.coalesce(normalized, text)


def without_markup(text: Column) -> Column:
    """The steps of cleaning that come before normalization.

    Links, mentions and hashtags are looked for only in text that holds their marks, which a byte search tells.
    """
    marked = reduce(or_, (F.contains(text, F.lit(mark)) for mark in ("http", "www.", "@", "#")))
    plain = F.when(marked, strip_hashtag_marks(strip_mentions(strip_urls(text)))).otherwise(text)
    return squeeze_runs(F.coalesce(plain, F.lit("")))


def clean_text(text: Column) -> Column:
    """Remove links, mentions and hashtag marks, squeeze runs, normalize, keep lower-cased letters."""
    return letters_only(normalize_nfkc(without_markup(text)))


def with_clean_text(df: DataFrame, text: str = "text", out: str = "cleaned_text") -> DataFrame:
    """``clean_text`` as a column of ``df``.

    The text before normalization gets a projection of its own: it is read both by the Arrow function
    and by its fallback, and would otherwise be computed twice.
    """
    return (
        df.withColumn(out, without_markup(F.col(text)))
        .withColumn(out, normalize_nfkc(F.col(out)))
        .withColumn(out, letters_only(F.col(out)))
    )


def clean_text_light(text: Column) -> Column:
    """The short cleaner: only ``http`` links and mentions are removed, runs and hashtags stay."""
    text = F.coalesce(text, F.lit(""))
    return letters_only(strip_mentions(F.regexp_replace(text, f"http{NON_SPACE}+", "")))


def tokenize(cleaned: Column, stopwords: Sequence[str] = STOPWORDS, min_len: int = 3) -> Column:
    """Words of cleaned text in order, repeats kept, short words and stopwords dropped."""
    words = F.split(F.coalesce(cleaned, F.lit("")), " ")
    return F.filter(words, lambda w: (F.length(w) >= min_len) & ~w.isin(*stopwords))


def tokenize_plain(cleaned: Column) -> Column:
    """Lower-cased words of cleaned text, nothing dropped."""
    return F.split(F.lower(cleaned), " ")


def first_case(branches: Iterable[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first condition that holds."""
    chain = F
    for condition, value in branches:
        chain = chain.when(condition, value)
    return otherwise if chain is F else chain.otherwise(otherwise)


def stem_word(word: Column, rules: Sequence[tuple[str, str]] = SUFFIX_RULES) -> Column:
    """Replace the first matching suffix. A word may be nothing but a suffix, so stems can be empty.

    Rules are asked by the last letter of the word, which leaves few of them to try. All suffixes that a word can
    match share that letter, so the order among them is kept.
    """

    def replaced(suffix: str, replacement: str) -> tuple[Column, Column]:
        kept = F.left(word, F.length(word) - len(suffix))
        return F.endswith(word, F.lit(suffix)), F.concat(kept, F.lit(replacement))

    by_letter: dict[str, list[tuple[Column, Column]]] = {}
    for suffix, replacement in rules:
        by_letter.setdefault(suffix[-1], []).append(replaced(suffix, replacement))
    groups = ((F.endswith(word, F.lit(letter)), first_case(group, word)) for letter, group in by_letter.items())
    return first_case(groups, word)


def stem(tokens: Column, rules: Sequence[tuple[str, str]] = SUFFIX_RULES) -> Column:
    return F.transform(tokens, lambda w: stem_word(w, rules))


def join_tokens(tokens: Column) -> Column:
    """Tokens with single spaces between them; empty stems leave double spaces."""
    return F.concat_ws(" ", tokens)


def space_split(text: Column, min_len: int = 1) -> Column:
    """Lower-cased runs of non-space characters; punctuation stays attached to its word."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"{NON_SPACE}{{{min_len},}}"), F.lit(0))


# Word rules of the counting operators: text -> array of words.


def words_letters(text: Column) -> Column:
    """Runs of three or more letters, once double quotes are gone."""
    return F.regexp_extract_all(F.lower(F.translate(text, '"', "")), F.lit(f"{LETTER}{{3,}}"), F.lit(0))


def words_alpha(text: Column) -> Column:
    """Space-separated words of three or more letters and nothing else."""
    pattern = f"(?<!{NON_SPACE}){LETTER}{{3,}}+(?!{NON_SPACE})"
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lower)


def words_raw(text: Column) -> Column:
    """Space-separated words of three or more characters, punctuation kept."""
    words = F.regexp_extract_all(text, F.lit(f"{NON_SPACE}{{3,}}"), F.lit(0))
    return F.transform(words, F.lower)


def words_mapreduce(text: Column) -> Column:
    """Runs of three or more letters, once link schemes are gone."""
    text = F.replace(F.replace(F.lower(text), F.lit("http://"), F.lit("")), F.lit("https://"), F.lit(""))
    return F.regexp_extract_all(text, F.lit(f"{LETTER}{{3,}}"), F.lit(0))


def words_cleaned(text: Column) -> Column:
    """Words of the lightly cleaned text."""
    return F.array_remove(F.split(clean_text_light(text), " "), "")


WORD_RULES = {
    "letters": words_letters,
    "alpha": words_alpha,
    "raw": words_raw,
    "mapreduce": words_mapreduce,
    "cleaned": words_cleaned,
}
