"""Joins, lexicons, word counts, reports and splits on small fixtures."""

from collections import Counter

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from wordtide.fixed_values import MESSAGE_TEXTS, SAMPLE_POSTS, STOPWORDS, TOKEN_LEXICON
from wordtide.functions import keys, sentiment
from wordtide.functions.arrays import bigrams, explode_words, term_counts
from wordtide.operators import joins, lexicon, reports, wordstats
from wordtide.session import fresh_path, shared_folder, stage


def posts_frame(spark, texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id STRING, text STRING")


# Joins


def test_counted_join_is_whole_for_hot_and_cold_keys(spark):
    facts = spark.range(1000).select("id", F.when(F.col("id") < 400, "hot").otherwise((F.col("id") % 97).cast("string")).alias("term"))
    counted = stage(facts.groupBy("term").agg(F.count("*").alias("df")), "counted")
    joined = joins.counted_join(facts, counted, "term", "df", share=10)
    want = Counter(r.term for r in facts.collect())
    assert joined.count() == 1000
    assert all(r.df == want[r.term] for r in joined.collect())


# Lexicons


HARD_LEXICONS = {
    "whole": ([("good", 1), ("bad", -2)], "word STRING, weight INT", {"good": 1, "bad": -2}),
    "double": ([("good", 0.75), ("bad", -0.5)], "word STRING, weight DOUBLE", {"good": 0.75, "bad": -0.5}),
    "null weight": ([("good", 1), ("bad", None)], "word STRING, weight INT", {"good": 1, "bad": None}),
    "repeated": ([("good", 1), ("good", 2), ("bad", -2)], "word STRING, weight INT", {"good": 3, "bad": -2}),
}


@pytest.mark.parametrize("kind", HARD_LEXICONS)
def test_lexicon_plans_agree(spark, kind):
    table, schema, mapping = HARD_LEXICONS[kind]
    texts = ["good", "good good bad", "none", "", None, "bad good good", " Good\tday "]
    posts = spark.createDataFrame([("same" if i < 2 else str(i), t) for i, t in enumerate(texts)], "id STRING, text STRING")
    frame = spark.createDataFrame(table, schema)
    inline = lexicon.lexicon_score(posts, mapping)
    joined, shuffled = lexicon.lexicon_score(posts, frame), lexicon.lexicon_score(posts, frame, "merge")
    assert inline.dtypes == joined.dtypes == shuffled.dtypes
    assert rows(inline) == rows(joined) == rows(shuffled)
    assert inline.count() == len(texts)


def test_lexicon_score_matches_whole_tokens(spark):
    df = posts_frame(spark, ["great!", "great", "Love love bad", "nothing here", "", None, " sad\tday "])
    scored = lexicon.lexicon_score(df, TOKEN_LEXICON)
    want = [("0", 0, "Neutral"), ("1", 1, "Positive"), ("2", 1, "Positive"), ("3", 0, "Neutral"), ("4", 0, "Neutral"),
            ("5", 0, "Neutral"), ("6", -1, "Negative")]
    assert rows(scored) == want
    assert "Exchange" not in plan(scored) and "Join" not in plan(scored)
    assert rows(lexicon.lexicon_score(df, lexicon.lexicon_table(spark, TOKEN_LEXICON))) == want
    inline = df.where("text IS NOT NULL").select("id", sentiment.token_score(F.col("text")).alias("s"))
    assert rows(inline) == [(i, s) for i, s, _ in want if i != "5"]


def test_lexicon_join_folds_before_the_shuffle(spark):
    scored = lexicon.lexicon_score(posts_frame(spark, ["a b"]), lexicon.lexicon_table(spark, TOKEN_LEXICON))
    assert "partial_sum" in plan(scored)


def test_sample_posts(spark):
    scored = lexicon.lexicon_score(posts_frame(spark, SAMPLE_POSTS), TOKEN_LEXICON)
    assert [r[1] for r in rows(scored)] == [2, -1, 2, -2, 2]


def test_substring_score_counts_each_word_once(spark):
    df = posts_frame(spark, ["download", "love love", "WHY so slow", None, *MESSAGE_TEXTS])
    score = sentiment.substring_score(F.col("text"))
    got = [r[1] for r in sorted(df.select(F.col("id").cast("int"), score).collect())]
    assert got == [-1, 1, -2, None, 1, 0, 1, -2, 1, 1, 0, -2, 1, 1]


def test_predictors(spark):
    df = posts_frame(spark, ["So GOOD", "meh", "love good great awesome happy nice cool"])
    keyword = df.select("id", sentiment.keyword_predict(F.col("text")).alias("p")).select("id", "p.*")
    assert rows(keyword) == [("0", "Positive", 0.89), ("1", "Negative", 0.89), ("2", "Positive", 0.89)]
    confidence = df.select("id", sentiment.confidence_predict(F.col("text")).alias("p")).select("id", "p.*")
    assert rows(confidence) == [("0", "Positive", 0.6), ("1", "Negative", 0.5), ("2", "Positive", 1.2)]


def test_remove_stopwords_keeps_positions(spark):
    tokens = spark.createDataFrame([("1", 0, "the"), ("1", 1, "cat"), ("1", 2, "cat")], "id STRING, pos INT, token STRING")
    assert rows(lexicon.remove_stopwords(tokens).select("id", "pos", "token")) == [("1", 1, "cat"), ("1", 2, "cat")]
    assert len(STOPWORDS) == len(set(STOPWORDS)) == 187


# Word statistics and arrays


def test_term_counts_equal_brute_force(spark):
    docs = [(1, ["b", "a", "b", "", "b"]), (2, []), (3, ["x"]), (4, ["y"] * 1000 + ["z"])]
    df = spark.createDataFrame(docs, "id INT, tokens ARRAY<STRING>")
    want = sorted((i, t, n) for i, ts in docs for t, n in Counter(ts).items())
    assert sorted(tuple(r) for r in term_counts(df, "tokens", "id").collect()) == want
    assert "Exchange" not in plan(term_counts(df, "tokens", "id"))


def test_bigrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t ARRAY<STRING>")
    assert [r[0] for r in df.select(bigrams(F.col("t"))).collect()] == [["a b", "b c"], [], []]


def test_explode_words_computes_the_array_once(spark, small):
    from wordtide.sources.tables import documents

    words = wordstats.words_of(documents(spark, small), "letters")
    assert plan(words).count("regexp_extract_all") == 1
    assert rows(explode_words(spark.createDataFrame([([],), (["q"],)], "w ARRAY<STRING>"), F.col("w"), pos=True)) == [(0, "q")]


def test_word_count_ignores_missing_text(spark):
    counts = wordstats.word_count(posts_frame(spark, [None, "one two two"]), "letters")
    assert rows(counts) == [("one", 1), ("two", 2)]


def test_top_words_breaks_ties_by_word(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", 1)], "word STRING, n BIGINT")
    top = wordstats.top_words(counts, 3)
    assert rows(top, "rank", "word") == [(1, "c"), (2, "a"), (3, "b")]
    assert "TakeOrderedAndProject" in plan(top)


def test_top_words_by_limits_each_task_before_the_shuffle(spark):
    counts = spark.range(1000).select((F.col("id") % 2).alias("label"), F.col("id").cast("string").alias("word"), F.col("id").alias("n"))
    top = wordstats.top_words_by(counts, 2, "label")
    assert rows(top, "label", "word", "rank") == [(0, "996", 2), (0, "998", 1), (1, "997", 2), (1, "999", 1)]
    assert plan(top).count("WindowGroupLimit") == 2


def test_approximate_words_are_close(spark, small):
    from wordtide.sources.tables import documents

    docs = documents(spark, small)
    exact, approx = wordstats.unique_words(docs).first()[0], wordstats.unique_words_approx(docs).first()[0]
    assert abs(approx - exact) <= 0.05 * exact


def test_corpus_stats_of_nothing(spark):
    empty = spark.createDataFrame([], "id STRING, text STRING, polarity INT")
    assert tuple(wordstats.corpus_stats(empty, empty).first()) == (0, 0, 0, None, 0, 0)


# Reports


def test_pivot_defaults_to_zero(spark):
    scored = spark.createDataFrame([("Positive",), ("Positive",)], "sentiment STRING")
    assert tuple(reports.sentiment_pivot(scored).first()) == (2, 0, 0, 2)


def test_trend_fills_missing_days(spark):
    scored = spark.createDataFrame([("2024-01-01", "Positive"), ("2024-01-04", "Negative")], "ts STRING, sentiment STRING")
    days = reports.daily_trend(scored.withColumn("ts", F.to_timestamp("ts")))
    assert [tuple(r)[1:] for r in sorted(days.collect())] == [(1, 0), (0, 0), (0, 0), (0, 1)]
    assert reports.daily_trend(scored.limit(0).withColumn("ts", F.to_timestamp("ts"))).count() == 0


def test_best_model_takes_the_first_of_equals(spark):
    metrics = spark.createDataFrame([("b", 1, 0.5, 0.8), ("a", 0, 0.4, 0.8), ("c", 2, 0.9, 0.7)], "model_name STRING, position INT, accuracy DOUBLE, f1 DOUBLE")
    assert reports.best_model(metrics).first()["model_name"] == "a"
    found = reports.model_metadata(metrics, 2, "f").first()
    assert (found["best_model"], found["total_models_trained"]) == ("a", 3)
    assert reports.model_metadata(metrics.limit(0), 2, "f").count() == 0


def test_throughput_report(spark):
    runs = spark.createDataFrame([("sequential", 10000, 45.0), ("spark", 10000, 8.5), ("broken", 10, 0.0)], "method STRING, records BIGINT, seconds DOUBLE")
    got = {r["method"]: r for r in reports.throughput_report(runs, "sequential").collect()}
    assert round(got["spark"]["speedup"], 1) == 5.3 and round(got["spark"]["gain_pct"]) == 429
    assert got["broken"]["throughput"] is None and got["broken"]["speedup"] is None


def test_rollup_adds_up(spark):
    posts = spark.createDataFrame([("a", 0), ("a", 4), ("b", 4), ("b", 4)], "source STRING, polarity INT")
    totals = {(r["source"], r["level"]): r["n"] for r in reports.source_label_rollup(posts).collect() if r["level"]}
    assert totals == {("a", 1): 2, ("b", 1): 2, (None, 3): 4}


# Keys


def test_splits_do_not_depend_on_layout(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    split = keys.split_name(F.col("id")).alias("s")
    one, many = rows(ids.coalesce(1).select("id", split)), rows(ids.repartition(13).select("id", split))
    assert one == many
    assert 0.78 < sum(s == "train" for _, s in one) / 5000 < 0.82
    sampled = ids.where(keys.in_sample(F.col("id"), 0.1)).count()
    assert 400 < sampled < 600
    folds = Counter(r[0] for r in ids.select(keys.fold(F.col("id"))).collect())
    assert set(folds) == {0, 1} and min(folds.values()) > 2300


def test_post_date_slug_and_run_id(spark):
    df = spark.createDataFrame([("Mon Apr 06 22:19:45 PDT 2009",), ("nonsense",)], "d STRING")
    parsed = df.select(keys.parse_post_date(F.col("d")).cast("string")).collect()
    assert [r[0] for r in parsed] == ["2009-04-07 05:19:45", None]
    one = df.limit(1).select(keys.slug(F.lit("Random Forest")), keys.run_id(F.lit("m"), F.lit("2024-01-02 03:04:05").cast("timestamp")))
    assert tuple(one.first()) == ("random_forest", "m_20240102_030405")


# Session


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x").startswith(shared_folder(spark) + "/x-")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_rows_per_partition(spark):
    df = spark.range(100).repartitionByRange(4, "id")
    assert sum(r.n for r in reports.rows_per_partition(df).collect()) == 100
    assert tuple(reports.partition_balance(spark.range(0)).first())[1] == 0


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_building_a_query_runs_no_job_and_moves_no_text(spark, small, broadcast):
    from wordtide.plans import queries

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        group = f"built-{broadcast}"
        spark.sparkContext.setJobGroup(group, group)
        queries.labelled(spark, small)
        metrics = queries.QUERIES["classification_metrics"](spark, small)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        for line in plan(metrics).split("\n"):
            assert "Join" not in line or "text" not in line
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
