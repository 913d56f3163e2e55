"""Words of a lexicon table found anywhere in texts, by an index of rare q-grams.

A lexicon of up to ``BROADCAST_BYTES`` is filed by the first letters of each word and sent to the tasks. The places of a text
are sorted by what follows there, so those that begin with a word are neighbours: the word counts at the first of them, and
only sums leave the row.

A larger one is joined to the tokens of the texts by shuffles. A word can only be inside a text if its longest part without blanks is inside one of the text's tokens. So words are
looked up in the distinct tokens of all texts, which are far fewer than their places: every word is filed under the one
of its q-grams that the fewest tokens have, tokens are joined to words on that q-gram, and each pair is verified. The
found pairs are then joined to the texts by token. All joins are on equal keys, and none needs either side to be small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.functions.arrays import explode_words
from wordtide.functions.keys import text_digest
from wordtide.functions.sentiment import sentiment_class
from wordtide.session import stage

# Runs of blanks are tokens too, for the sake of words that are nothing else.
TOKENS = r"\s+|\S+"
GRAM = 3
# Letters that words are filed under, and letters that are compared at a place; longer words are looked for in the text too.
FILED, PLACE = 5, 32
BROADCAST_BYTES = 32 << 20
WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0))


def gram_rows(values: DataFrame, value: str, sizes: list[int], *keep: str) -> DataFrame:
    """One row per distinct q-gram of ``value``, for every q in ``sizes``: the ``keep`` columns and ``gram``."""
    chars = values.select(*dict.fromkeys([*keep, value]), F.split(value, "").alias("_chars"))
    n = F.size("_chars")

    def of_size(q: int) -> Column:
        at = F.transform(F.sequence(F.lit(1), n - q + 1), lambda i: F.array_join(F.slice("_chars", i, q), ""))
        return F.when(n >= q, at).otherwise(F.array().cast("array<string>"))

    return explode_words(chars, F.array_distinct(F.concat(*(of_size(q) for q in sizes))), *keep, out="gram")


def searchable(lexicon: DataFrame) -> DataFrame:
    """Distinct words with their summed weight, the part to look for, and the size of the q-grams that it is filed under."""
    whole = dict(lexicon.dtypes)["weight"] in WHOLE_TYPES
    words = lexicon.where("word IS NOT NULL AND weight IS NOT NULL").groupBy("word").agg(F.sum("weight").cast("bigint" if whole else "double").alias("weight"))
    parts = F.transform(tokens_of(F.col("word")), lambda p: F.struct(F.rlike(p, F.lit(r"\S")).alias("full"), F.length(p).alias("n"), p.alias("part")))
    best = F.array_max(parts)
    return words.select("word", "weight", best["part"].alias("part"), F.least(best["n"], F.lit(GRAM)).alias("q"))


def file_words(words: DataFrame, tokens: DataFrame, sizes: list[int]) -> DataFrame:
    """Each word under its rarest q-gram among the tokens; words with a q-gram that no token has are left out."""
    own = gram_rows(words, "part", sizes, "word", "q").where(F.length("gram") == F.col("q")).select("word", "gram")
    asked = own.select("gram").distinct()
    found = gram_rows(tokens, "token", sizes, "token").join(asked, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = own.join(found, "gram", "left").groupBy("word").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("rarest"))
    return words.join(rarest.where("rarest.n > 0"), "word").select("word", "weight", "part", F.col("rarest.gram").alias("gram"))


def match_tokens(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Rows of token, word, weight: every word whose longest part is inside a token, written to the shared folder."""
    words = stage(searchable(lexicon).where("part IS NOT NULL"), "substring-words")
    sizes = sorted(r.q for r in words.select("q").distinct().collect()) or [GRAM]
    filed = stage(file_words(words, tokens, sizes), "substring-index")
    pairs = gram_rows(tokens, "token", sizes, "token").join(filed, "gram")
    return stage(pairs.where(F.contains("token", "part")).select("token", "word", "weight"), "substring-matches")


def sorted_places(texts: DataFrame, sizes: list[int], *keep: str) -> DataFrame:
    """The ``keep`` columns, ``text``, and for each of its places, sorted by the letters ``at`` it, what is ``before`` it in this
    order and ``gram``, its first letters in each of ``sizes``. Of the smaller sizes the first place of a gram is enough.

    The first row of a text is the empty gram, with nothing before it.
    """
    # Half of a surrogate pair is no place.
    places = F.regexp_extract_all("text", F.lit(rf"(?s)(?=((?![\x{{DC00}}-\x{{DFFF}}]).{{1,{PLACE}}}))"), F.lit(1))
    ordered = texts.select(*keep, "text", F.concat(F.array(F.lit("")), F.sort_array(places)).alias("_places"))
    rows = explode_words(ordered, F.sequence(F.lit(0), F.size("_places") - 1), *keep, "text", "_places", out="_i")
    pairs = rows.select(*keep, "text", F.get("_places", F.col("_i")).alias("at"), F.get("_places", F.col("_i") - 1).alias("before"))
    cut = pairs.select("*", F.explode(F.array(*map(F.lit, [0, *sizes]))).alias("_q")).withColumn("gram", F.left("at", F.col("_q")))
    first = F.col("before").isNull() | ~F.startswith("before", "gram")
    return cut.where((F.length("gram") == F.col("_q")) & (first | (F.col("_q") == FILED))).select(*keep, "text", "at", "before", "gram")


def summed_in_rows(posts: DataFrame, words: DataFrame) -> DataFrame:
    """id, ``t1``, ``t2`` and ``summed``, the weights of the words in the text, by a broadcast of ``words``: word, weight.

    Equal rows give one row. Nothing but sums is shuffled.
    """
    whole = dict(words.dtypes)["weight"] == "bigint"
    sizes = sorted(r.q for r in words.select(F.least(F.length("word"), F.lit(FILED)).alias("q")).distinct().collect())
    # The empty word counts the rows that are equal, whose weights are added up together.
    counter = words.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(0).cast(words.schema["weight"].dataType).alias("weight"))
    filed = words.unionByName(counter).select(
        "word", "weight", F.left("word", F.lit(FILED)).alias("gram"), F.left("word", F.lit(PLACE)).alias("_head"), (F.length("word") > PLACE).alias("_long")
    )
    key = ["id", "t1", "t2"]
    texts = posts.select("id", *text_digest("text"), F.lower("text").alias("text"))
    here = F.startswith("at", "_head") & (F.col("before").isNull() | ~F.startswith("before", "_head"))
    found = sorted_places(texts, sizes, *key).join(F.broadcast(filed), "gram").where(here & (~F.col("_long") | F.contains("text", "word")))
    weight = F.col("weight").cast("decimal(20,0)") if whole else F.col("weight")
    sums = found.groupBy(*key).agg(F.sum(weight).alias("_all"), F.count_if(F.col("word") == "").alias("_rows"))
    return sums.select(*key, (F.col("_all") / F.col("_rows")).cast("bigint" if whole else "double").alias("summed"))


def matched_words(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """id, the text's digest ``t1``, ``t2`` and ``words``, the set of (word, weight) that the lower-case text contains.

    Equal rows give one row; texts without any of the words none.
    """
    texts = posts.select("id", *text_digest("text"), F.lower("text").alias("text"))
    tokens = explode_words(texts, F.array_distinct(tokens_of(F.col("text"))), "id", "t1", "t2", out="token")
    vocabulary = stage(tokens.select("token").distinct(), "substring-tokens")
    matches = match_tokens(vocabulary, lexicon)
    spaced = F.rlike("word", F.lit(r"\s")) & F.rlike("word", F.lit(r"\S"))
    key = ["id", "t1", "t2"]
    found = tokens.join(matches.where(~spaced), "token").select(*key, "word", "weight")
    longer = matches.where(spaced)
    if not longer.isEmpty():
        # A word with blanks inside was only found in part: the text itself decides.
        likely = stage(tokens.join(longer, "token").select(*key, "word", "weight").distinct(), "substring-likely")
        same = reduce(Column.__and__, (texts[k].eqNullSafe(likely[k]) for k in key))
        sure = texts.join(likely, same).where(F.contains(texts["text"], likely["word"]))
        found = found.unionByName(sure.select(*(likely[k] for k in key), likely["word"], likely["weight"]))
    return found.groupBy(*key).agg(F.collect_set(F.struct("word", "weight")).alias("words"))


def substring_score_join(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """id, score and sentiment of each row of ``posts``, by a table of ``word`` and ``weight``.

    The score is the sum of the weights of the words that occur anywhere in the lower-case text, each counted once, as
    ``functions.sentiment.substring_score`` gives it for a mapping. It is a whole number if all weights are; a word
    listed twice has both weights; NULL words and weights count nothing, and the empty word is in every text. A NULL
    text has neither score nor class. Rows that repeat an id are scored one by one.
    """
    whole = dict(lexicon.dtypes)["weight"] in WHOLE_TYPES
    zero = F.lit(0).cast("bigint" if whole else "double")
    words = stage(searchable(lexicon).where("word <> ''").select("word", "weight"), "substring-lexicon")
    if words.agg(F.coalesce(F.sum(F.octet_length("word") + 64), F.lit(0))).first()[0] <= BROADCAST_BYTES:
        summed = summed_in_rows(posts, words)
    else:
        total = F.aggregate("words", zero, lambda sum_, w: sum_ + w["weight"])
        summed = matched_words(posts, lexicon).select("id", "t1", "t2", total.alias("summed"))
    summed = summed.select(F.struct("id", "t1", "t2").alias("_key"), "summed")
    everywhere = lexicon.where("word = ''").agg(F.coalesce(F.sum("weight"), zero).cast("bigint" if whole else "double")).scalar()
    rows = posts.select("id", F.col("text").isNotNull().alias("known"), F.struct("id", *text_digest("text")).alias("_key"))
    both = rows.join(summed, rows["_key"].eqNullSafe(summed["_key"]), "left")
    score = F.when(F.col("known"), F.coalesce("summed", zero) + everywhere)
    return both.select("id", score.alias("score")).withColumn("sentiment", sentiment_class(F.col("score")))
