"""Substring lexicons in tables, against a plain loop over all texts and words."""

import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from wordtide.operators import lexicon, substring
from wordtide.session import stage

POSTS, LEXICON = "id STRING, text STRING", "word STRING, weight INT"


def plain_scores(posts, words):
    weights = {}
    for word, weight in words:
        if word is not None and weight is not None:
            weights[word] = weights.get(word, 0) + weight
    return sorted(((i, None if t is None else sum(n for w, n in weights.items() if w in t.lower())) for i, t in posts), key=repr)


def random_text(letters, most):
    return "".join(random.choice(letters) for _ in range(random.randrange(most)))


def test_scores_equal_the_plain_loop(spark):
    random.seed(1)
    letters = "abcdeé 漢\t😀"
    posts = [(str(i % 50), random_text(letters, 40)) for i in range(200)]
    posts += [("n", None), ("e", ""), (None, "abc abc"), ("1", "AbC dE"), ("1", "AbC dE"), ("blank", " \t ")]
    words = [(random_text(letters, 6), random.randrange(-3, 4)) for _ in range(400)]
    words += [(None, 5), ("zz", None), ("b c", 2), (" ", 1), ("\t ", 7), ("", 3), ("ABC", 9), ("not there", 1)]
    got = substring.substring_score_join(spark.createDataFrame(posts, POSTS).repartition(3), spark.createDataFrame(words, LEXICON))
    assert rows(got, "id", "score") == plain_scores(posts, words)


def test_scores_through_shuffles_equal_those_in_rows(spark, monkeypatch):
    random.seed(3)
    letters = "abcdeé 漢\t\n😀"
    posts = [(str(i % 50), random_text(letters, 60)) for i in range(200)] + [("d", "ab ab"), ("d", "ab ab"), (None, None)]
    posts += [("q", "😀ab ?"), ("long", "x" * 50 + "y"), ("long", "x" * 40), ("tail", "abca")]
    words = [(random_text(letters, 9), random.randrange(-3, 4)) for _ in range(300)]
    words += [("?ab", 50), ("x" * 32, 60), ("x" * 40 + "y", 70), ("xxxxy", 80), ("bca", 90), ("xy" * 30, 95)]
    for most in (substring.BROADCAST_BYTES, 0):
        monkeypatch.setattr(substring, "BROADCAST_BYTES", most)
        got = substring.substring_score_join(spark.createDataFrame(posts, POSTS), spark.createDataFrame(words, LEXICON))
        assert rows(got, "id", "score") == plain_scores(posts, words)


def test_no_more_than_the_lexicon_is_written(spark, monkeypatch):
    random.seed(4)
    posts = [(str(i), " ".join(random_text("abc", 8) for _ in range(40))) for i in range(300)]
    words = [(w, 1) for w in {random_text("abc ", 5) for _ in range(100)}]
    written = []
    monkeypatch.setattr(substring, "stage", lambda df, name: written.append(stage(df, name)) or written[-1])
    got = substring.substring_score_join(spark.createDataFrame(posts, POSTS), spark.createDataFrame(words, LEXICON))
    assert rows(got, "id", "score") == plain_scores(posts, words)
    assert max(df.count() for df in written) <= len(words) + 1


@pytest.mark.parametrize("words", [[], [("", 2)], [(" ", 1)], [("a", 1), ("a", 2)], [("zzz", 4)]])
def test_small_lexicons(spark, words):
    posts = [("1", "a b"), ("2", "c"), ("3", None), ("3", None), ("4", "")]
    got = substring.substring_score_join(spark.createDataFrame(posts, POSTS), spark.createDataFrame(words, LEXICON))
    assert rows(got, "id", "score") == plain_scores(posts, words)


def test_fractions_and_empty_tables(spark):
    words = spark.createDataFrame([("ab", 0.5), ("b", 0.25)], "word STRING, weight DOUBLE")
    posts = spark.createDataFrame([("1", "ab"), ("2", "b"), ("3", "")], POSTS)
    assert rows(substring.substring_score_join(posts, words), "id", "score") == [("1", 0.75), ("2", 0.25), ("3", 0.0)]
    assert substring.substring_score_join(posts.where("false"), words).count() == 0


def test_a_large_lexicon_has_no_nested_loop(spark, monkeypatch):
    random.seed(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = list(dict.fromkeys("".join(random.choices(letters, k=random.randrange(2, 10))) for _ in range(130_000)))[:100_000]
    assert len(words) == 100_000
    posts = [(str(i), " ".join(random_text(letters, 12) for _ in range(60)) + f" {words[i]} {words[i + 1]}x") for i in range(12)]
    table = spark.createDataFrame([(w, i % 7 - 3) for i, w in enumerate(words)], LEXICON)
    plans = []
    monkeypatch.setattr(substring, "stage", lambda df, name: plans.append(plan(df)) or stage(df, name))
    got = substring.substring_score_join(spark.createDataFrame(posts, POSTS), table)
    assert rows(got, "id", "score") == plain_scores(posts, [(w, i % 7 - 3) for i, w in enumerate(words)])
    for text in [*plans, plan(got)]:
        assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def test_a_hot_token_is_looked_up_once(spark):
    posts = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.lit("hot hot token").alias("text"))
    words = spark.createDataFrame([("hot", 1), ("ot t", 2), ("ken", 4)], LEXICON)
    assert substring.substring_score_join(posts, words).groupBy("score").count().collect() == [(7, 2000)]
    tokens = spark.createDataFrame([("hot",), ("token",)], "token STRING")
    assert rows(substring.match_tokens(tokens, words)) == [("hot", "hot", 1), ("hot", "ot t", 2), ("token", "ken", 4)]


def test_words_are_filed_under_their_rarest_gram(spark):
    tokens = spark.createDataFrame([("abcde",), ("abcdx",), ("abcq",), ("cdez",)], "token STRING")
    words = substring.searchable(spark.createDataFrame([("abcd", 1), ("bcde", 1), ("none", 1)], LEXICON))
    assert rows(substring.file_words(words, tokens, [3]), "word", "gram") == [("abcd", "bcd"), ("bcde", "bcd")]


def test_rows_of_one_id_are_scored_one_by_one(spark):
    posts = spark.createDataFrame([("1", "good bad"), ("1", "good"), ("1", "good"), (None, "good"), ("2", None), ("2", "")], POSTS)
    table = lexicon.lexicon_table(spark, {"good": 1, "bad": -2})
    want = [("1", -1), ("1", 1), ("1", 1), ("2", 0), ("2", 0), (None, 1)]
    assert rows(lexicon.lexicon_score(posts.repartition(3), table), "id", "score") == want
