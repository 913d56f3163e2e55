"""The registered queries. Each takes a session and a folder of Parquet tables and returns a DataFrame."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.fixed_values import (
    CORPUS_LEXICON,
    CV_FOLDS,
    MESSAGE_TEXTS,
    SAMPLE_POSTS,
    TOKEN_LEXICON,
    WORD2VEC_MIN_COUNT,
    WORD2VEC_SIZE,
)
from wordtide.functions import keys, text
from wordtide.functions.arrays import bigrams, explode_words
from wordtide.functions.sentiment import (
    binary_label,
    confidence_predict,
    keyword_predict,
    sentiment_class,
    substring_score,
    token_score,
)
from wordtide.operators import evaluation, features, lexicon, models, reports, substring, word_vectors, wordstats
from wordtide.operators.preprocess import preprocess, valid_posts, with_stems, with_tokens
from wordtide.operators.word2vec import Word2Vec
from wordtide.schemas import EVENT_PROPS, MODEL_METRICS, PREPROCESSED
from wordtide.session import configure, fresh_path, stage
from wordtide.sources import messages, posts_csv, sinks, tables
from wordtide.streaming import scoring, toplist
from wordtide.streaming import sinks as stream_sinks
from wordtide.streaming.sources import stream_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query as its name after ``q_``; it runs with the settings the operators need."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__.removeprefix("q_")] = run
    return run


# Inputs


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, spread over all cores for text work."""
    return tables.spread(tables.documents(spark, sf_dir), "id")


def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their own key, spread over all cores."""
    return tables.spread(tables.read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_posts(tables.with_polarity(spark, sf_dir, scan(spark, sf_dir)))


def labelled_answers(spark: SparkSession, sf_dir: str, **answers) -> DataFrame:
    """id, label and columns computed from the text, of the valid posts. The texts stay where they are read."""
    given = scan(spark, sf_dir).where(F.length("text") > 0).select("doc_id", *(c.alias(k) for k, c in answers.items()))
    posts = tables.with_polarity(spark, sf_dir, given).where(F.col("polarity").isin(0, 4))
    return posts.select("id", binary_label(F.col("polarity")).alias("label"), *answers)


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated message per event."""
    events = tables.read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return messages.as_messages(events, "event_id", F.col("user_id"), F.col("ts"))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.lexicon_score(docs(spark, sf_dir), CORPUS_LEXICON)


# Filters and labels


@query
def q_valid_posts(spark, sf_dir):
    return valid_posts(tables.posts(spark, sf_dir)).select("id", "polarity")


@query
def q_binary_label(spark, sf_dir):
    label = binary_label(F.col("polarity"))
    return valid_posts(tables.posts(spark, sf_dir)).select(
        "id", "polarity", label.alias("label"), label.cast("double").alias("label_double")
    )


@query
def q_label_counts(spark, sf_dir):
    posts = valid_posts(tables.posts(spark, sf_dir))
    return wordstats.count_by(posts, binary_label(F.col("polarity")).alias("label"))


@query
def q_partition_invariance(spark, sf_dir):
    """The same counts whether rows stay where the scan put them or are spread over more partitions."""
    width = spark.sparkContext.defaultParallelism
    labels = valid_posts(tables.posts(spark, sf_dir)).select("id", binary_label(F.col("polarity")).alias("label"))
    layouts = {
        "as_read": labels,
        "by_cores": labels.repartition(width, "id"),
        "many": labels.repartition(4 * width, "id"),
    }
    counts = [wordstats.count_by(df, "label").withColumn("layout", F.lit(name)) for name, df in layouts.items()]
    return functools.reduce(DataFrame.unionByName, counts).select("layout", "label", "n")


# Text


@query
def q_clean_text(spark, sf_dir):
    return text.with_clean_text(docs(spark, sf_dir)).select("id", "cleaned_text")


@query
def q_clean_text_pages(spark, sf_dir):
    """The same cleaner over raw web pages, which hold links."""
    pages = tables.spread(tables.read_table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text")), "page_id")
    return text.with_clean_text(pages).select("page_id", "cleaned_text")


@query
def q_clean_text_light(spark, sf_dir):
    return docs(spark, sf_dir).select("id", text.clean_text_light(F.col("text")).alias("cleaned_text"))


@query
def q_tokenize(spark, sf_dir):
    return explode_words(with_tokens(docs(spark, sf_dir)), F.col("tokens"), "id", out="token", pos=True)


@query
def q_tokenize_plain(spark, sf_dir):
    tokens = text.tokenize_plain(text.clean_text_light(F.col("text")))
    return explode_words(docs(spark, sf_dir), tokens, "id", out="token", pos=True)


@query
def q_stopword_anti_join(spark, sf_dir):
    cleaned = text.with_clean_text(docs(spark, sf_dir))
    words = explode_words(cleaned, F.split("cleaned_text", " "), "id", out="token", pos=True)
    return lexicon.remove_stopwords(words.where(F.length("token") > 2)).select("id", "pos", "token")


@query
def q_stem(spark, sf_dir):
    return explode_words(with_stems(docs(spark, sf_dir)), F.col("stemmed_tokens"), "id", out="stem", pos=True)


@query
def q_processed_text(spark, sf_dir):
    return with_stems(docs(spark, sf_dir)).select("id", "processed_text")


# Word statistics


@query
def q_word_count_letters(spark, sf_dir):
    return wordstats.word_count(docs(spark, sf_dir), "letters")


@query
def q_word_count_alpha(spark, sf_dir):
    return wordstats.word_count(docs(spark, sf_dir), "alpha")


@query
def q_word_count_raw(spark, sf_dir):
    return wordstats.word_count(docs(spark, sf_dir), "raw")


@query
def q_word_count_mapreduce(spark, sf_dir):
    return wordstats.word_count(docs(spark, sf_dir), "mapreduce")


@query
def q_word_count_sql(spark, sf_dir):
    return wordstats.word_count(docs(spark, sf_dir), "cleaned")


@query
def q_top_words(spark, sf_dir):
    return wordstats.top_words(wordstats.word_count(docs(spark, sf_dir), "cleaned"), 20)


@query
def q_top_words_by_label(spark, sf_dir):
    """The 20 most frequent tokens of each class, stopwords removed."""
    tokens = with_tokens(labelled(spark, sf_dir))
    words = explode_words(tokens, F.col("tokens"), binary_label(F.col("polarity")).alias("label"))
    return wordstats.top_words_by(wordstats.count_words(words, "label"), 20, "label")


@query
def q_corpus_stats(spark, sf_dir):
    return wordstats.corpus_stats(docs(spark, sf_dir), tables.posts(spark, sf_dir).select("polarity"))


@query
def q_unique_words(spark, sf_dir):
    return wordstats.unique_words(docs(spark, sf_dir))


@query
def q_unique_words_approx(spark, sf_dir):
    return wordstats.unique_words_approx(docs(spark, sf_dir))


@query
def q_unique_words_sketched(spark, sf_dir):
    """Distinct words by source and overall, and whether stored sketches, merged where needed, are within a twentieth."""
    sketches = stage(wordstats.word_sketches(docs(spark, sf_dir), "source"), "word-sketches")
    everything = wordstats.merge_sketches(sketches).withColumn("source", F.lit("all"))
    estimates = wordstats.estimated_words(sketches.unionByName(everything)).withColumnRenamed("unique_words", "estimate")
    counts = stage(wordstats.words_of(docs(spark, sf_dir), "letters", "source").distinct(), "distinct-words")
    total = counts.agg(F.count_distinct("word").alias("unique_words")).withColumn("source", F.lit("all"))
    exact = counts.groupBy("source").agg(F.count("*").alias("unique_words")).unionByName(total)
    near = F.abs(F.col("estimate") - F.col("unique_words")) * 20 <= F.col("unique_words")
    return exact.join(estimates, "source").select("source", "unique_words", near.alias("near"))


# Lexicons and heuristic predictors


@query
def q_lexicon_score(spark, sf_dir):
    return scored_documents(spark, sf_dir)


@query
def q_lexicon_score_join(spark, sf_dir):
    """The same score through the join that a lexicon in a table takes."""
    return lexicon.lexicon_score(docs(spark, sf_dir), lexicon.lexicon_table(spark, CORPUS_LEXICON))


@query
def q_lexicon_score_salted(spark, sf_dir):
    """The same score through the shuffled join of lexicons too large to broadcast, whose large words Spark splits."""
    return lexicon.lexicon_score(docs(spark, sf_dir), lexicon.lexicon_table(spark, CORPUS_LEXICON), "merge")


@query
def q_lexicon_score_samples(spark, sf_dir):
    """Token lexicon over one sample text per event."""
    texts = F.array(*(F.lit(t) for t in (*SAMPLE_POSTS, *MESSAGE_TEXTS)))
    pick = F.get(texts, F.pmod("event_id", F.lit(len(SAMPLE_POSTS) + len(MESSAGE_TEXTS))).cast("int"))
    samples = tables.read_table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), pick.alias("text"))
    return lexicon.lexicon_score(samples, TOKEN_LEXICON)


@query
def q_lexicon_score_conversations(spark, sf_dir):
    score = token_score(F.col("text"), TOKEN_LEXICON)
    return tables.read_table(spark, sf_dir, "conversations").select("conv_id", "turn", score.alias("score"))


@query
def q_substring_score(spark, sf_dir):
    score = substring_score(F.col("text"), CORPUS_LEXICON)
    scored = docs(spark, sf_dir).select("id", score.alias("score"))
    return scored.withColumn("sentiment", sentiment_class(F.col("score")))


@query
def q_substring_score_join(spark, sf_dir):
    """The same score through the q-gram index that a lexicon in a table takes."""
    return substring.substring_score_join(docs(spark, sf_dir), lexicon.lexicon_table(spark, CORPUS_LEXICON))


def benchmark_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words and adjacent word pairs of the benchmark, with a weight that follows from their length."""
    words = tables.read_table(spark, sf_dir, "benchmark").select(F.split(F.lower("text"), " ").alias("w"))
    both = words.select("w", bigrams(F.col("w")).alias("pairs")).select(F.explode(F.concat("w", "pairs")).alias("word"))
    return both.where("word <> ''").distinct().select("word", (F.length("word") % 5 - 2).alias("weight"))


@query
def q_substring_score_vocabulary(spark, sf_dir):
    """Every word and word pair of the benchmark looked for in every document."""
    return substring.substring_score_join(docs(spark, sf_dir), benchmark_lexicon(spark, sf_dir))


@query
def q_substring_score_messages(spark, sf_dir):
    scored = scoring.score_messages(event_messages(spark, sf_dir))
    return scored.select("event_id", "text", "score", "sentiment")


@query
def q_keyword_predict(spark, sf_dir):
    return event_messages(spark, sf_dir).select("event_id", "text", keyword_predict(F.col("text")).alias("p")).select(
        "event_id", "text", "p.*"
    )


@query
def q_confidence_predict(spark, sf_dir):
    return event_messages(spark, sf_dir).select("event_id", "text", confidence_predict(F.col("text")).alias("p")).select(
        "event_id", "text", "p.*"
    )


@query
def q_keyword_predict_documents(spark, sf_dir):
    return docs(spark, sf_dir).select("id", keyword_predict(F.col("text")).alias("p")).select("id", "p.*")


@query
def q_confidence_predict_documents(spark, sf_dir):
    return docs(spark, sf_dir).select("id", confidence_predict(F.col("text")).alias("p")).select("id", "p.*")


# Reports


@query
def q_partition_balance(spark, sf_dir):
    """Rows by partition of the documents' scan; every row is in one of them, however many there are."""
    balance = reports.partition_balance(tables.read_table(spark, sf_dir, "documents"))
    sound = (F.col("fewest") <= F.col("most")) & (F.col("most") * F.col("partitions") >= F.col("n"))
    return balance.select("n", sound.alias("sound"))


@query
def q_sentiment_counts(spark, sf_dir):
    return reports.sentiment_counts(scored_documents(spark, sf_dir))


@query
def q_sentiment_pivot(spark, sf_dir):
    return reports.sentiment_pivot(scored_documents(spark, sf_dir))


@query
def q_sentiment_trends(spark, sf_dir):
    return reports.sentiment_trends(tables.scored_events(spark, sf_dir))


@query
def q_daily_trend(spark, sf_dir):
    return reports.daily_trend(tables.scored_events(spark, sf_dir))


@query
def q_kpi_summary(spark, sf_dir):
    return reports.kpi_summary(tables.posts(spark, sf_dir))


@query
def q_source_polarity_counts(spark, sf_dir):
    return reports.source_polarity_counts(valid_posts(tables.posts(spark, sf_dir)))


@query
def q_source_label_rollup(spark, sf_dir):
    return reports.source_label_rollup(valid_posts(tables.posts(spark, sf_dir)))


@query
def q_recent_predictions(spark, sf_dir):
    return reports.recent_predictions(tables.scored_events(spark, sf_dir).select("event_id", "ts", "sentiment"))


@query
def q_preview(spark, sf_dir):
    return reports.preview(tables.posts(spark, sf_dir))


@query
def q_throughput_report(spark, sf_dir):
    """Event types as methods, their values as seconds; views are the baseline."""
    runs = tables.read_table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("method")).agg(
        F.count("*").alias("records"), F.sum("value").alias("seconds")
    )
    return reports.throughput_report(runs, "view")


# Evaluation. The predictors are fixed rules, so their metrics can be checked by value.


def lexicon_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid posts with lexicon score and prediction: id, label, score, prediction."""
    score = token_score(F.col("text"), CORPUS_LEXICON)
    scored = labelled_answers(spark, sf_dir, score=score)
    return scored.withColumn("prediction", F.when(F.col("score") < 0, 0.0).otherwise(1.0))


def heuristic_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of three rule-based models over the valid posts, from one pass: every post votes once per model."""
    post = F.col("text")
    rules = {
        "Token Lexicon": token_score(post, CORPUS_LEXICON) >= 0,
        "Substring Lexicon": substring_score(post, CORPUS_LEXICON) >= 0,
        "Keyword Rule": keyword_predict(post)["sentiment"] == "Positive",
    }
    votes = [
        F.struct(F.lit(name).alias("model_name"), F.lit(i).alias("position"), rule.cast("double").alias("prediction"))
        for i, (name, rule) in enumerate(rules.items())
    ]
    predictions = labelled_answers(spark, sf_dir, votes=F.array(*votes)).select("label", F.inline("votes"))
    return evaluation.classification_metrics(predictions, "model_name", "position")


@query
def q_classification_metrics(spark, sf_dir):
    return evaluation.classification_metrics(lexicon_predictions(spark, sf_dir))


@query
def q_auc_roc(spark, sf_dir):
    return evaluation.auc_roc(lexicon_predictions(spark, sf_dir))


@query
def q_auc_roc_values(spark, sf_dir):
    """AUC of a score with many distinct values: event value as a sign of error events."""
    events = tables.read_table(spark, sf_dir, "events")
    error = (F.col("event_type") == "error").cast("int")
    return evaluation.auc_roc(events.select(error.alias("label"), F.col("value").alias("score")))


@query
def q_best_model(spark, sf_dir):
    return reports.best_model(heuristic_metrics(spark, sf_dir)).select("model_name", "f1")


@query
def q_model_comparison(spark, sf_dir):
    return reports.model_comparison(heuristic_metrics(spark, sf_dir), evaluation.METRICS)


@query
def q_model_metadata(spark, sf_dir):
    return reports.model_metadata(heuristic_metrics(spark, sf_dir), CV_FOLDS, models.TFIDF)


@query
def q_metrics_json_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "metrics-json")
    heuristic_metrics(spark, sf_dir).write.json(path)
    read = spark.read.schema(MODEL_METRICS).json(path)
    return reports.model_comparison(read, evaluation.METRICS)


@query
def q_published_predictions(spark, sf_dir):
    """All predictions through the publishing sink, read back."""
    def hits(sign: int):
        words = [w for w, weight in CORPUS_LEXICON.items() if weight == sign]
        return F.size(F.filter(text.space_split(F.col("text")), lambda w: w.isin(*words)))

    scored = labelled_answers(spark, sf_dir, score_neg=hits(-1), score_pos=hits(1)).withColumnRenamed("label", "actual_label")
    predicted = scored.withColumn("predicted_label", (F.col("score_pos") >= F.col("score_neg")).cast("int"))
    base = fresh_path(spark, "published")
    sinks.publish(spark, base, predictions=predicted)
    return sinks.published(spark, base)["predictions"].select("id", "actual_label", "predicted_label", "score_neg", "score_pos")


@query
def q_published_set(spark, sf_dir):
    """Two tables published together twice: what readers get is the second set, and it fits together."""
    base = fresh_path(spark, "published")
    scored = scored_documents(spark, sf_dir)
    for positive in (True, False):
        kept = stage(scored.where(F.col("score") >= 0) if positive else scored, "published-scores")
        sinks.publish(spark, base, scores=kept, counts=reports.sentiment_counts(kept))
    tables_ = sinks.published(spark, base)
    counted = tables_["scores"].groupBy("sentiment").agg(F.count("*").alias("rows"))
    return tables_["counts"].join(counted, "sentiment").select("sentiment", "n", "rows")


# Sources and sinks


@query
def q_csv_roundtrip(spark, sf_dir):
    posts = tables.with_polarity(spark, sf_dir, scan(spark, sf_dir)).select(
        "polarity",
        "id",
        F.lit(None).cast("string").alias("date"),
        F.lit("NO_QUERY").alias("query"),
        F.col("source").alias("user"),
        "text",
    )
    path = fresh_path(spark, "posts-csv")
    posts_csv.write_posts(posts, path)
    return posts_csv.read_posts(spark, path, multi_line=True).select("id", "polarity", "text")


@query
def q_quarantine(spark, sf_dir):
    """Raw lines made of the documents: unlabelled ones lack a field, poor ones a readable polarity."""
    docs_ = tables.read_table(spark, sf_dir, "documents")
    labels = tables.read_table(spark, sf_dir, "labels")
    polarity = F.when(F.col("quality") == 0, "n/a").when(F.col("toxic") == 0, "4").when(F.col("toxic") == 1, "0")
    line = F.concat_ws(",", polarity, "doc_id", "lang", "source", "n_chars", "text")
    lines = docs_.join(labels, "doc_id", "left").select(line.alias("value"))
    good, bad = posts_csv.split_lines(lines)
    return wordstats.count_by(bad, "reason").unionByName(good.agg(F.lit("valid").alias("reason"), F.count("*").alias("n")))


@query
def q_partitioned_write(spark, sf_dir):
    path = fresh_path(spark, "preprocessed")
    posts = labelled(spark, sf_dir).withColumn("date", F.lit(None).cast("string"))
    sinks.write_preprocessed(preprocess(posts), path)
    read = spark.read.schema(PREPROCESSED).parquet(path)
    return read.groupBy("label").agg(
        F.count("*").alias("n"), F.sum(F.size("stemmed_tokens")).cast("bigint").alias("stems")
    )


@query
def q_land_raw_counts(spark, sf_dir):
    zone = fresh_path(spark, "zones")
    names = ["documents", "labels", "conversations", "benchmark", "events", "pages"]
    landed = [sinks.land_raw(spark, tables.read_table(spark, sf_dir, name), zone, name) for name in names]
    return functools.reduce(DataFrame.unionByName, landed)


@query
def q_land_verified(spark, sf_dir):
    """Tables copied to the raw zone, with the content of both sides compared."""
    zone = fresh_path(spark, "zones")
    names = ["documents", "labels", "conversations", "benchmark", "events", "pages", "embeddings", "part"]
    landed = [sinks.land_verified(spark, tables.read_table(spark, sf_dir, name), zone, name) for name in names]
    return functools.reduce(DataFrame.unionByName, landed)


@query
def q_multi_source_union(spark, sf_dir):
    frames = {
        "documents": tables.read_table(spark, sf_dir, "documents").select("text", "lang"),
        "conversations": tables.read_table(spark, sf_dir, "conversations").select("text", "role"),
        "benchmark": tables.read_table(spark, sf_dir, "benchmark").select("text"),
    }
    union = tables.union_sources(frames)
    return union.groupBy("source").agg(
        F.count("*").alias("n"), F.count("lang").alias("with_lang"), F.sum(F.length("text")).alias("chars")
    )


@query
def q_synthetic_multi_source(spark, sf_dir):
    """A generated post per event, with the event type as its source."""
    generated = messages.feed(tables.read_table(spark, sf_dir, "events"), "event_type", "event_id")
    return generated.groupBy("source", "polarity").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("text").alias("last_text")
    )


@query
def q_message_encode(spark, sf_dir):
    encoded = messages.encode(event_messages(spark, sf_dir), "event_id", "text", "user", "timestamp")
    return messages.parse(encoded, "event_id BIGINT, text STRING, user STRING, timestamp STRING")


@query
def q_events_props_json(spark, sf_dir):
    props = F.from_json("props", EVENT_PROPS)
    return tables.read_table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


@query
def q_parse_post_date(spark, sf_dir):
    """Event times written as post dates and parsed again."""
    events = tables.read_table(spark, sf_dir, "events")
    written = F.concat_ws(" ", F.date_format("ts", "EEE MMM dd HH:mm:ss"), F.lit("UTC"), F.date_format("ts", "yyyy"))
    return events.select("event_id", keys.parse_post_date(written).cast("timestamp_ntz").alias("posted"))


@query
def q_model_slug(spark, sf_dir):
    return tables.read_table(spark, sf_dir, "part").select("p_partkey", keys.slug(F.col("p_name")).alias("slug"))


# Splits


@query
def q_train_test_split(spark, sf_dir):
    return tables.documents(spark, sf_dir).select("id", keys.split_name(F.col("id")).alias("split"))


@query
def q_keyed_sample(spark, sf_dir):
    return tables.documents(spark, sf_dir).where(keys.in_sample(F.col("id"), 0.05)).select("id")


@query
def q_fold_assignment(spark, sf_dir):
    return tables.documents(spark, sf_dir).select("id", keys.fold(F.col("id")).alias("fold"))


# Features


def stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stems of all documents, computed once: id, split, stemmed_tokens."""
    stems = with_stems(docs(spark, sf_dir)).select("id", keys.split_name(F.col("id")).alias("split"), "stemmed_tokens")
    return stage(stems, "stems")


@query
def q_tfidf_terms(spark, sf_dir):
    return features.tfidf_terms(stemmed(spark, sf_dir), "stemmed_tokens")


@query
def q_bigrams(spark, sf_dir):
    stems = with_stems(docs(spark, sf_dir)).select("id", "stemmed_tokens")
    return features.bigram_rows(stems, "stemmed_tokens")


@query
def q_bigram_vocabulary(spark, sf_dir):
    stems = with_stems(docs(spark, sf_dir)).select("id", "stemmed_tokens")
    return features.bigram_vocabulary(stems, "stemmed_tokens")


@query
def q_mean_embedding(spark, sf_dir):
    return features.mean_vectors(tables.read_table(spark, sf_dir, "embeddings"), "label", "embedding")


def training_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preprocessed valid posts with their split, computed once."""
    posts = preprocess(labelled(spark, sf_dir)).withColumn("split", keys.split_name(F.col("id")))
    return stage(posts.select("id", "label", "split", "text", "cleaned_text", "stemmed_tokens"), "training-posts")


def featured(spark: SparkSession, sf_dir: str, stages: Callable[[], list]) -> tuple[DataFrame, DataFrame]:
    """Train and test posts with the features of ``stages``, fitted on the training posts."""
    posts = training_posts(spark, sf_dir)
    train = posts.where("split = 'train'")
    if any(isinstance(one, Word2Vec) for one in stages()):
        features.check_word2vec_vocabulary(train, "stemmed_tokens", WORD2VEC_SIZE, WORD2VEC_MIN_COUNT)
    chain = stages()
    for one in chain:
        if isinstance(one, Word2Vec):
            one.setNumPartitions(features.word2vec_tasks(train, "stemmed_tokens"))
    both = Pipeline(stages=chain).fit(train).transform(posts)
    return both.where("split = 'train'"), both.where("split = 'test'")


def tfidf_posts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return featured(spark, sf_dir, features.tfidf_stages)


@query
def q_hashing_tf(spark, sf_dir):
    posts = training_posts(spark, sf_dir)
    hashed = features.tfidf_stages()[0].transform(posts)
    return hashed.select("id", "label", *features.sparse_arrays("raw_features"))


@query
def q_tfidf_vectors(spark, sf_dir):
    train, test = tfidf_posts(spark, sf_dir)
    return train.unionByName(test).select("id", "label", "split", *features.sparse_arrays("tfidf_features"))


@query
def q_word2vec(spark, sf_dir):
    train, test = featured(spark, sf_dir, lambda: [features.word2vec_stage()])
    return train.unionByName(test).select("id", "label", vector_to_array("word2vec_features").alias("word2vec_features"))


@query
def q_feature_table(spark, sf_dir):
    posts = training_posts(spark, sf_dir)
    train = posts.where("split = 'train'")
    model = features.feature_model(train, features.word2vec_tasks(train, "stemmed_tokens"))
    return model.transform(posts).select(
        "id",
        "label",
        "split",
        *features.sparse_arrays("tfidf_features"),
        vector_to_array("word2vec_features").alias("word2vec_features"),
        *features.sparse_arrays("bigram_features"),
    )


# What can be checked by value of features whose numbers have no SQL form.


@query
def q_unique_words_error(spark, sf_dir):
    """Exact number of distinct words, and whether the estimate is within a twentieth of it."""
    exact = wordstats.unique_words(docs(spark, sf_dir))
    estimate = wordstats.unique_words_approx(docs(spark, sf_dir)).scalar()
    near = F.abs(estimate - F.col("unique_words")) * 20 <= F.col("unique_words")
    return exact.select("unique_words", near.alias("near"))


@query
def q_hashing_tf_totals(spark, sf_dir):
    """Term occurrences of each post in its hashed vector: as many as it has stems."""
    hashed = features.tfidf_stages()[0].transform(training_posts(spark, sf_dir))
    values = F.col("raw_features_values")
    vectors = hashed.select("id", "label", "split", *features.sparse_arrays("raw_features"))
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v).cast("bigint")
    return vectors.select("id", "label", "split", total.alias("stems"))


@query
def q_feature_facts(spark, sf_dir):
    """Every valid post with its split, the size of its word vector, and whether its weights are sound."""
    table = q_feature_table(spark, sf_dir)
    sound = F.forall("tfidf_features_values", lambda v: v >= 0) & (F.size("tfidf_features_values") == F.size("tfidf_features_indices"))
    return table.select("id", "label", "split", F.size("word2vec_features").alias("size"), sound.alias("sound"))


@query
def q_reload_facts(spark, sf_dir):
    """Every test post, and whether the reloaded model predicts what the saved one did."""
    return q_model_roundtrip(spark, sf_dir).select("id", "label", (F.col("before") == F.col("prediction")).alias("same"))


def block_vectors(posts: DataFrame) -> DataFrame:
    """Word vectors trained over three blocks, as larger vocabularies have them."""
    return word_vectors.train_word_vectors(posts, rounds=1, blocks=3)


@query
def q_word_vector_facts(spark, sf_dir):
    """Every frequent stem with its count, the size of its vector, and whether the vector is finite and not zero."""
    vectors = block_vectors(stemmed(spark, sf_dir))
    fine = F.forall("vector", lambda v: F.abs(v) < 1e6) & F.exists("vector", lambda v: v != 0)
    return vectors.select("word", "n", F.size("vector").alias("size"), fine.alias("sound"))


@query
def q_document_vector_facts(spark, sf_dir):
    """Every document with the size of its mean vector, and whether any of its stems has a vector."""
    posts = stemmed(spark, sf_dir)
    means = word_vectors.mean_word_vectors(posts, "stemmed_tokens", stage(block_vectors(posts), "word-vectors"), WORD2VEC_SIZE)
    return means.select("id", F.size("vector").alias("size"), F.exists("vector", lambda v: v != 0).alias("known"))


# Models


def predictions_of(name: str, train: DataFrame, test: DataFrame) -> DataFrame:
    return models.fit(name, train).transform(test).select("id", "label", "prediction")


@query
def q_train_random_forest(spark, sf_dir):
    return predictions_of("Random Forest", *tfidf_posts(spark, sf_dir))


@query
def q_train_linear_svm(spark, sf_dir):
    return predictions_of("Linear SVM", *tfidf_posts(spark, sf_dir))


@query
def q_train_mlp(spark, sf_dir):
    return predictions_of("MLP", *featured(spark, sf_dir, lambda: [features.word2vec_stage()]))


@query
def q_train_logistic(spark, sf_dir):
    return predictions_of("Logistic Regression", *featured(spark, sf_dir, features.light_stages))


@query
def q_train_naive_bayes(spark, sf_dir):
    return predictions_of("Naive Bayes", *tfidf_posts(spark, sf_dir))


@query
def q_train_gbt(spark, sf_dir):
    return predictions_of("Gradient-Boosted Trees", *tfidf_posts(spark, sf_dir))


@query
def q_cross_validate(spark, sf_dir):
    """Tuned model on the test posts: metrics of the best setting."""
    train, test = tfidf_posts(spark, sf_dir)
    best, _, _ = models.cross_validate("Linear SVM", train)
    metrics = evaluation.classification_metrics(best.transform(test))
    return metrics.withColumn("model_name", F.lit("Linear SVM"))


@query
def q_batch_predict(spark, sf_dir):
    """Test posts scored by a fitted model and published as a table."""
    train, test = featured(spark, sf_dir, features.light_stages)
    scored = models.fit("Logistic Regression", train).transform(test)
    served = sinks.published_predictions(scored, "Logistic Regression", datetime(2024, 1, 1))
    base = fresh_path(spark, "batch")
    sinks.publish(spark, base, batch_predictions=served)
    return sinks.published(spark, base)["batch_predictions"]


@query
def q_model_roundtrip(spark, sf_dir):
    """A saved and reloaded model next to the one in memory."""
    train, test = featured(spark, sf_dir, features.light_stages)
    model = models.fit("Logistic Regression", train)
    path = models.save_model(model, fresh_path(spark, "models"), "Logistic Regression")
    again = LogisticRegressionModel.load(path)
    both = model.transform(test).select("id", "label", "words", models.TFIDF, F.col("prediction").alias("before"))
    return again.transform(both).select("id", "label", "before", "prediction")


@query
def q_train_facts(spark, sf_dir):
    """For each classifier: test posts, whether it predicts known classes only, and does no worse than the majority class
    on the posts that it was fitted to."""
    hashed, vectors = tfidf_posts(spark, sf_dir), featured(spark, sf_dir, lambda: [features.word2vec_stage()])
    facts = []
    for name in models.MODELS:
        train, test = vectors if name == "MLP" else hashed
        scored = models.fit(name, train).transform(train.unionByName(test)).select("split", "label", "prediction")
        fitted = F.col("split") == "train"
        right = F.count_if(fitted & (F.col("label") == F.col("prediction")))
        majority = F.greatest(F.count_if(fitted & (F.col("label") == 1)), F.count_if(fitted & (F.col("label") == 0)))
        known = F.min(F.col("prediction").isin(0.0, 1.0))
        facts.append(scored.agg(F.lit(name).alias("model_name"), F.count_if(~fitted).alias("n"), known.alias("known"), (right >= majority).alias("fits")))
    return functools.reduce(DataFrame.unionByName, facts)


@query
def q_batch_predict_facts(spark, sf_dir):
    """Every test post with its label, whether its published class is known, and whether its scores are two."""
    served = q_batch_predict(spark, sf_dir)
    return served.select("id", "actual_label", F.col("predicted_label").isin(0, 1).alias("known"), (F.size("raw_scores") == 2).alias("two"))


@query
def q_cross_validate_facts(spark, sf_dir):
    """Whether the tuned model's metrics are shares."""
    metrics = q_cross_validate(spark, sf_dir)
    return metrics.select("model_name", *(F.col(m).between(0, 1).alias(m) for m in evaluation.METRICS))


# Streams. Each runs over the present files and returns what its sink holds.


@query
def q_stream_parse(spark, sf_dir):
    raw = messages.encode(stream_table(spark, sf_dir, "events"), "event_id", "props")
    parsed = messages.parse(raw, "event_id BIGINT, props STRING")
    rows = parsed.select("event_id", F.from_json("props", EVENT_PROPS)["k"].alias("k"))
    return stream_sinks.run_to_table(rows, fresh_path(spark, "stream")).select("event_id", "k")


@query
def q_stream_score(spark, sf_dir):
    documents = stream_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    scored = scoring.parse_and_score(messages.encode(documents, "id", "text"), "id STRING, text STRING", CORPUS_LEXICON)
    rows = scored.select("id", "score", "sentiment")
    return stream_sinks.run_to_table(rows, fresh_path(spark, "stream")).drop("batch_id")


@query
def q_stream_score_table(spark, sf_dir):
    """Documents scored by a lexicon in a table, which every micro-batch is joined to."""
    documents = stream_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    words = lexicon.lexicon_table(spark, CORPUS_LEXICON)
    scored = lambda batch: substring.substring_score_join(batch, words)
    return stream_sinks.run_to_table(documents, fresh_path(spark, "stream"), change=scored).drop("batch_id")


@query
def q_stream_append(spark, sf_dir):
    """Generated messages through parsing, scoring and the micro-batch sink."""
    events = stream_table(spark, sf_dir, "events")
    sent = messages.as_messages(events, "event_id", F.col("user_id"), F.col("ts"))
    raw = messages.encode(sent, "event_id", "text", "user", "timestamp")
    scored = scoring.parse_and_score(raw, "event_id BIGINT, text STRING, user STRING, timestamp STRING")
    return stream_sinks.run_to_table(scored, fresh_path(spark, "stream")).drop("batch_id")


def streamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return events.select("event_id", "ts", "event_type", tables.event_class(F.col("event_type")).alias("sentiment"))


@query
def q_stream_sentiment_counts(spark, sf_dir):
    return stream_sinks.run_to_totals(streamed_events(spark, sf_dir), reports.sentiment_counts, fresh_path(spark, "stream"))


def stream_trend(spark: SparkSession, sf_dir: str, window: str, slide: str | None = None) -> DataFrame:
    counted = lambda df: scoring.trend(df, "ts", window, slide)
    totals = stream_sinks.run_to_totals(streamed_events(spark, sf_dir), counted, fresh_path(spark, "stream"))
    return totals.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query
def q_stream_trend_tumbling(spark, sf_dir):
    return stream_trend(spark, sf_dir, "1 day")


@query
def q_stream_trend_sliding(spark, sf_dir):
    return stream_trend(spark, sf_dir, "2 days", "1 day")


@query
def q_stream_top_words(spark, sf_dir):
    """The 20 most frequent words of a stream of documents, from its bounded summary."""
    documents = stream_table(spark, sf_dir, "documents").select("text")
    counted = lambda df: wordstats.word_count(df, "cleaned")
    top = toplist.run_to_top_words(documents, counted, fresh_path(spark, "stream"), 20)
    return top.select("word", F.col("least").alias("n"), "rank", "sure")


@query
def q_stream_dedup(spark, sf_dir):
    """Every event is delivered twice and kept once."""
    twice = streamed_events(spark, sf_dir).union(streamed_events(spark, sf_dir)).select("event_id", "event_type")
    return stream_sinks.run_to_unique(twice, "event_id", fresh_path(spark, "stream")).drop("batch_id")
