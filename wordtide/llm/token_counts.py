"""Token counts from a cache of digests: only texts that the cache doesn't know are encoded, once each."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm.common import by_batch, fresh_path, let, shared_folder, whole
from wordtide.llm.tokens import BYTE_BPE, encoder, tokenizer_digest

CACHE = "content BINARY, tokenizer STRING, n_tokens BIGINT"


def content_digest(text: Column) -> Column:
    """SHA-256 of the normalised content. Normalising only takes NULL as empty: more would change counts."""
    return F.unhex(F.sha2(text, 256))


def read_cache(docs: DataFrame, cache: str, version: str) -> DataFrame:
    """Known counts of one tokenizer version; empty where there is no cache yet.

    A count that two jobs have added at once is there twice, with the same value, and is taken once.
    """
    spark = docs.sparkSession
    try:
        known = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException:
        known = spark.createDataFrame([], CACHE)
    return known.where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _count(tokenizer: str, version: str):
    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        lengths = [len(ids) // 4 for ids in encoder(tokenizer).encode(batch["text"])]
        return pd.DataFrame({"content": batch["content"], "tokenizer": version, "n_tokens": np.array(lengths, "i8")})

    return by_batch(rows)


def add_missing(docs: DataFrame, cache: str, tokenizer: str = BYTE_BPE) -> None:
    """Encode each different text that the cache lacks, and append the counts to it.

    A repeated append of a lost task is undone by Spark's commit; rows that are known already never change a count.
    Copies are folded in the task that reads them before texts are shuffled by digest.
    """
    version = tokenizer_digest(tokenizer)
    keyed = docs.select(let(whole(), lambda t: F.struct(content_digest(t).alias("content"), t.alias("text"))).alias("x")).select("x.*")
    missing = keyed.join(read_cache(docs, cache, version), "content", "left_anti")
    different = missing.groupBy("content").agg(F.first("text").alias("text"))
    different.mapInPandas(_count(tokenizer, version), CACHE).write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, cache: str | None = None, tokenizer: str = BYTE_BPE, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row of ``docs``.

    ``cache`` is a folder that later calls can share; it defaults to a new one. A NULL text counts as empty (0 tokens).
    Repeated rows each get a row; a NULL id stays NULL; an empty table gives no rows; other columns are not read.
    """
    cache = cache or fresh_path(docs.sparkSession, "token-counts")
    add_missing(docs, cache, tokenizer)
    known = read_cache(docs, cache, tokenizer_digest(tokenizer))
    keyed = docs.select("doc_id", let(whole(), lambda t: F.struct(F.octet_length(t).cast("bigint").alias("n_bytes"), content_digest(t).alias("content"))).alias("x"))
    return keyed.select("doc_id", "x.*").join(known, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def shared_cache(docs: DataFrame, name: str = "token-counts") -> str:
    """The folder of a cache that all jobs with the same shared folder use."""
    return f"{shared_folder(docs.sparkSession)}/{name}"
