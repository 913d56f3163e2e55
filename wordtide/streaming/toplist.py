"""The most frequent words of a stream, from a summary of bounded size that every micro-batch is added to.

The summary holds the ``size`` words with the highest possible counts. Of each it knows the least and the greatest count
that it can have, and of all others the greatest count that any of them can have, the ``floor``. A batch is counted
exactly; a word that was not in the summary may have occurred up to ``floor`` times before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from wordtide.sources import manifest
from wordtide.streaming.sinks import check_owner, read_segments, start, write_segment

SIZE = 100_000
SCHEMA = "word STRING, least BIGINT, most BIGINT"


def add_counts(summary: DataFrame, floor: int, counts: DataFrame) -> DataFrame:
    """``least`` and ``most`` of every word of the summary or of a batch's exact ``counts`` (word, n)."""
    old = summary.select("word", "least", "most", F.lit(0).cast("bigint").alias("n"))
    new = counts.select("word", F.lit(0).cast("bigint").alias("least"), F.lit(None).cast("bigint").alias("most"), "n")
    both = old.unionByName(new).groupBy("word").agg(F.sum("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n"))
    return both.select("word", (F.col("least") + F.col("n")).alias("least"), (F.coalesce("most", F.lit(floor)) + F.col("n")).alias("most"))


def add_batch(counts: DataFrame, batch_id: int, path: str, size: int = SIZE, owner: str | None = None) -> None:
    """Add the words of one micro-batch and commit the new summary; a batch that is committed is not added again."""
    spark = counts.sparkSession
    number, state = manifest.latest(spark, path)
    if state.get("batch", -1) >= batch_id:
        return
    check_owner(spark, path, owner)
    summary = read_segments(spark, path, state.get("segments", []), spark.createDataFrame([], SCHEMA).schema)
    added = add_counts(summary, state.get("floor", 0), counts)
    # One more than are kept: the count of the first that falls out is the new floor, as all others have no more.
    first = write_segment(added.orderBy(F.desc("most"), F.desc("least"), "word").limit(size + 1), path, batch_id)
    found = read_segments(spark, path, [first], summary.schema)
    floor, segment = state.get("floor", 0), first
    if found.count() > size:
        floor = max(floor, found.agg(F.min("most")).first()[0])
        segment = write_segment(found.orderBy(F.desc("most"), F.desc("least"), "word").limit(size), path, batch_id)
    manifest.commit(spark, path, number, {"owner": owner, "batch": batch_id, "floor": floor, "segments": [segment], "folders": [segment["folder"]]})
    if segment is not first:
        manifest.delete(spark, f"{path}/{first['folder']}")


def start_top_words(stream: DataFrame, count: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, size: int = SIZE, available_now: bool = True) -> StreamingQuery:
    """Keep the summary of ``count``, which turns a batch into rows of word and n."""
    return start(stream, lambda df, batch_id, path, owner: add_batch(count(df), batch_id, path, size, owner), path, checkpoint, "append", available_now)


def read_top_words(spark: SparkSession, path: str, k: int) -> DataFrame:
    """word, least, most, rank and sure of the ``k`` words with the highest least counts, ties by word.

    ``sure`` says that the count is exact and that no other word can have more than this one, except those before it.
    """
    state = manifest.latest(spark, path)[1]
    summary = read_segments(spark, path, state.get("segments", []), spark.createDataFrame([], SCHEMA).schema)
    order = [F.desc("least"), F.asc("word")]
    first = summary.orderBy(*order).limit(k + 1).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    others = summary.join(F.broadcast(first.where(F.col("rank") <= k).select("word")), "word", "left_anti")
    beyond = F.greatest(F.coalesce(others.agg(F.max("most")).scalar(), F.lit(0)), F.lit(state.get("floor", 0)))
    sure = (F.col("least") == F.col("most")) & (F.col("least") >= beyond)
    return first.where(F.col("rank") <= k).select("word", "least", "most", "rank", sure.alias("sure"))


def run_to_top_words(stream: DataFrame, count: Callable[[DataFrame], DataFrame], base: str, k: int, size: int = SIZE) -> DataFrame:
    """Run a stream over its present input and return its ``k`` most frequent words."""
    start_top_words(stream, count, f"{base}/top", f"{base}/checkpoint", size).awaitTermination()
    return read_top_words(stream.sparkSession, f"{base}/top", k)
