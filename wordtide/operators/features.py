"""Text features: Spark ML stages, and relational forms of TF-IDF and the bigram vocabulary."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, NGram, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordtide.fixed_values import (
    BIGRAM_MIN_DOCS,
    BIGRAM_VOCABULARY,
    HASH_BUCKETS,
    HASH_BUCKETS_LIGHT,
    MIN_DOC_FREQ,
    SEED,
    WORD2VEC_MIN_COUNT,
    WORD2VEC_SIZE,
)
from wordtide.functions.arrays import bigrams, explode_words, term_counts
from wordtide.operators.joins import counted_join
from wordtide.operators.word2vec import Word2Vec
from wordtide.session import stage

# Tasks that copies of word vectors are made for in training: more of them harm the vectors and move them more often. Where
# every task still gets this many words, there are as many tasks as cores.
WORD2VEC_TASKS = 8
WORD2VEC_TASK_WORDS = 2_000_000

# Spark ML keeps all word vectors in one float array on the driver. Ours are a table; the vocabulary is still held to this.
WORD2VEC_MAX_FLOATS = 2**31 - 1


def tfidf_stages(tokens: str = "stemmed_tokens", buckets: int = HASH_BUCKETS, min_doc_freq: int = MIN_DOC_FREQ) -> list:
    return [
        HashingTF(inputCol=tokens, outputCol="raw_features", numFeatures=buckets),
        IDF(inputCol="raw_features", outputCol="tfidf_features", minDocFreq=min_doc_freq),
    ]


def light_stages(cleaned: str = "cleaned_text", buckets: int = HASH_BUCKETS_LIGHT) -> list:
    """Plain tokenizer, hashing and IDF over cleaned text."""
    return [Tokenizer(inputCol=cleaned, outputCol="words"), *tfidf_stages("words", buckets, 0)]


def word2vec_stage(
    partitions: int = WORD2VEC_TASKS,
    tokens: str = "stemmed_tokens",
    size: int = WORD2VEC_SIZE,
    min_count: int = WORD2VEC_MIN_COUNT,
    seed: int = SEED,
) -> Word2Vec:
    """Word vectors, trained over blocks and kept in a table. ``partitions`` is how many tasks may share the training, where
    there are fewer blocks. On the same data and settings the vectors are the same."""
    return Word2Vec(
        vectorSize=size,
        minCount=min_count,
        numPartitions=partitions,
        seed=seed,
        inputCol=tokens,
        outputCol="word2vec_features",
    )


def word2vec_tasks(docs: DataFrame, tokens: str) -> int:
    """Tasks for training on ``docs``: ``WORD2VEC_TASKS``, or more if there are more cores and words enough for them."""
    words = docs.agg(F.sum(F.size(tokens))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return max(WORD2VEC_TASKS, min(cores, int(words) // WORD2VEC_TASK_WORDS))


def check_word2vec_vocabulary(docs: DataFrame, tokens: str, size: int, min_count: int) -> int:
    """Vocabulary size, counted on the cluster; an error when its vectors cannot be held in one model."""
    counts = explode_words(docs, F.col(tokens)).groupBy("word").agg(F.count("*").alias("n"))
    vocabulary = counts.where(F.col("n") >= min_count).count()
    if vocabulary * size > WORD2VEC_MAX_FLOATS:
        raise ValueError(
            f"{vocabulary} words of {size} dimensions are too many for one model; raise min_count or lower size"
        )
    return vocabulary


def bigram_stages(
    tokens: str = "stemmed_tokens", vocabulary: int = BIGRAM_VOCABULARY, min_docs: int = BIGRAM_MIN_DOCS
) -> list:
    return [
        NGram(n=2, inputCol=tokens, outputCol="bigrams"),
        CountVectorizer(inputCol="bigrams", outputCol="bigram_features", vocabSize=vocabulary, minDF=float(min_docs)),
    ]


def feature_model(
    train: DataFrame,
    partitions: int,
    buckets: int = HASH_BUCKETS,
    min_doc_freq: int = MIN_DOC_FREQ,
    size: int = WORD2VEC_SIZE,
    min_count: int = WORD2VEC_MIN_COUNT,
    vocabulary: int = BIGRAM_VOCABULARY,
    min_docs: int = BIGRAM_MIN_DOCS,
) -> PipelineModel:
    """All feature stages fitted on the training posts only."""
    check_word2vec_vocabulary(train, "stemmed_tokens", size, min_count)
    stages = [
        *tfidf_stages(buckets=buckets, min_doc_freq=min_doc_freq),
        *bigram_stages(vocabulary=vocabulary, min_docs=min_docs),
        # Last, so that no means are made for the fitting of other stages.
        word2vec_stage(partitions, size=size, min_count=min_count),
    ]
    return Pipeline(stages=stages).fit(train)


FEATURE_COLUMNS = ["id", "label", "text", "tfidf_features", "word2vec_features", "bigram_features"]


def sparse_arrays(vector: str) -> list:
    """The indices and values of a sparse vector column as array columns."""
    parts = F.unwrap_udt(vector)
    return [parts["indices"].alias(f"{vector}_indices"), parts["values"].alias(f"{vector}_values")]


def document_frequencies(pairs: DataFrame) -> DataFrame:
    """Documents per term, from one row per document and term."""
    return pairs.groupBy("term").agg(F.count("*").alias("df"))


def tfidf_terms(docs: DataFrame, tokens: str, min_doc_freq: int = MIN_DOC_FREQ) -> DataFrame:
    """Rows of id, split, term, tf, tfidf, by exact terms instead of hash buckets.

    ``idf = ln((N + 1) / (df + 1))``, and 0 for terms in fewer than ``min_doc_freq`` documents, is fitted on the rows
    whose ``split`` is train and weighs the terms of all rows; terms that no training document has are left out.
    """
    pairs = stage(term_counts(docs, tokens, "id", "split"), "term-counts")
    frequencies = stage(document_frequencies(pairs.where("split = 'train'")), "document-frequencies")
    n_docs = docs.where("split = 'train'").agg(F.count("*")).scalar()
    idf = F.when(F.col("df") >= min_doc_freq, F.log((n_docs + 1) / (F.col("df") + 1))).otherwise(0.0)
    joined = counted_join(pairs, frequencies, "term", "df")
    return joined.select("id", "split", "term", "tf", F.round(F.col("tf") * idf, 6).alias("tfidf"))


def bigram_rows(docs: DataFrame, tokens: str) -> DataFrame:
    """Rows of id, position, bigram."""
    return explode_words(docs, bigrams(F.col(tokens)), "id", out="bigram", pos=True)


def bigram_vocabulary(
    docs: DataFrame, tokens: str, size: int = BIGRAM_VOCABULARY, min_docs: int = BIGRAM_MIN_DOCS
) -> DataFrame:
    """The most frequent bigrams that occur in enough documents, with df, count and rank."""
    pairs = term_counts(docs.select(bigrams(F.col(tokens)).alias("bigrams")), "bigrams")
    counts = (
        pairs.groupBy(F.col("term").alias("bigram"))
        .agg(F.count("*").alias("df"), F.sum("tf").alias("n"))
        .where(F.col("df") >= min_docs)
    )
    order = [F.desc("n"), F.asc("bigram")]
    # The vocabulary size bounds what is ranked in one task.
    return counts.orderBy(*order).limit(size).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def mean_vectors(vectors: DataFrame, by: str, vector: str, digits: int = 6) -> DataFrame:
    """Mean of each vector position per group; groups are reduced before the shuffle."""
    return (
        vectors.select(by, F.posexplode(vector).alias("pos", "value"))
        .groupBy(by, "pos")
        .agg(F.round(F.avg(F.col("value").cast("double")), digits).alias("mean"))
    )
