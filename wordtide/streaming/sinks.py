"""Micro-batch sinks that can be retried, with a log of batches that readers follow.

A batch is written to a folder of its own and then committed by a manifest (``sources.manifest``), which names all
folders that count. So a batch is in the table as a whole or not at all, and one that is run again after its commit is
left out. Small segments are folded into larger ones as they gather, level by level, so that a table of many batches has
few files and every row is rewritten a few times only.

A table belongs to one checkpoint: batches of another stream would carry the same numbers, so they are refused.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from wordtide.functions.keys import text_digest
from wordtide.sources import manifest

# Segments of one level that are folded into one of the next.
FOLD = 8
# Bytes of a file that folding aims at, and of a segment that is not folded any more.
FILE_BYTES, FULL_BYTES = 128 << 20, 4 << 30
FULL = -1

Change = Callable[[DataFrame], DataFrame]


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that Spark has given to a checkpoint, or None before its first start."""
    text = manifest.read_text(spark, f"{checkpoint}/metadata")
    return json.loads(text)["id"] if text else None


def check_owner(spark: SparkSession, path: str, owner: str | None) -> None:
    """Refuse a table that another checkpoint has written."""
    state = manifest.latest(spark, path)[1]
    if state and state["owner"] != owner:
        raise ValueError(f"{path} holds the batches of another checkpoint: use its checkpoint, or a new path")


def write_segment(df: DataFrame, path: str, last: int, level: int = 0) -> dict:
    """Write rows as a segment: its folder, the last batch in it, its level and its size."""
    folder = manifest.new_folder(path)
    df.write.parquet(f"{path}/{folder}")
    return {"folder": folder, "last": last, "level": level, "bytes": manifest.size_of(df.sparkSession, f"{path}/{folder}")}


def read_segments(spark: SparkSession, path: str, segments: list[dict], schema: StructType) -> DataFrame:
    folders = [f"{path}/{s['folder']}" for s in segments]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def folded(spark: SparkSession, path: str, segments: list[dict], schema: StructType) -> list[dict]:
    """The segments, with every ``FOLD`` of one level put together as one of the next level, in whole files."""
    level = 0
    while any(s["level"] >= level for s in segments):
        same = [s for s in segments if s["level"] == level]
        if len(same) >= FOLD:
            total = sum(s["bytes"] for s in same)
            together = read_segments(spark, path, same, schema).coalesce(max(1, math.ceil(total / FILE_BYTES)))
            segment = write_segment(together, path, max(s["last"] for s in same), level + 1 if total < FULL_BYTES else FULL)
            segments = [s for s in segments if s["level"] != level] + [segment]
        level += 1
    return segments


def with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add("batch_id", LongType(), False)


def write_batch(df: DataFrame, batch_id: int, path: str, owner: str | None = None) -> None:
    """Write and commit one micro-batch. What a failed try has left is never read; a committed batch is not repeated."""
    spark = df.sparkSession
    number, state = manifest.latest(spark, path)
    if state.get("batch", -1) >= batch_id:
        return
    check_owner(spark, path, owner)
    segment = write_segment(df.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, batch_id)
    segments = folded(spark, path, [*state.get("segments", []), segment], with_batch(df.schema))
    manifest.commit(spark, path, number, {"owner": owner, "batch": batch_id, "segments": segments, "folders": [s["folder"] for s in segments]})


KEY_DIGEST = StructType().add("t1", LongType()).add("t2", LongType())


def write_new_keys(df: DataFrame, batch_id: int, path: str, key: str, owner: str | None = None) -> None:
    """Write and commit the rows of one micro-batch whose key no row before them had, one for each key.

    Digests of all keys are a table beside the rows, committed with them. A batch looks its keys up there: Spark sends
    the batch's digests to the table's tasks while they are few, so the table is scanned and not moved.
    """
    spark = df.sparkSession
    number, state = manifest.latest(spark, path)
    if state.get("batch", -1) >= batch_id:
        return
    check_owner(spark, path, owner)
    known = read_segments(spark, path, state.get("keys", []), KEY_DIGEST)
    once = df.dropDuplicates([key]).select("*", *text_digest(key))
    repeated = known.join(once.select("t1", "t2"), ["t1", "t2"], "left_semi")
    fresh = once.join(repeated, ["t1", "t2"], "left_anti").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    rows = write_segment(fresh.select(*df.columns, "batch_id", "t1", "t2"), path, batch_id)
    digests = write_segment(read_segments(spark, path, [rows], KEY_DIGEST), path, batch_id)
    segments = folded(spark, path, [*state.get("segments", []), rows], with_batch(df.schema))
    keys = folded(spark, path, [*state.get("keys", []), digests], KEY_DIGEST)
    folders = [s["folder"] for s in (*segments, *keys)]
    manifest.commit(spark, path, number, {"owner": owner, "batch": batch_id, "segments": segments, "keys": keys, "folders": folders})


def merge_batch(counts: DataFrame, batch_id: int, path: str, owner: str | None = None) -> None:
    """Add the ``n`` of one micro-batch to the totals of the batches before it, and commit them as the new totals.

    The totals' size is that of their keys. Nothing is ever too late to be counted, and nothing counts twice.
    """
    spark = counts.sparkSession
    number, state = manifest.latest(spark, path)
    if state.get("batch", -1) >= batch_id:
        return
    check_owner(spark, path, owner)
    keys = [c for c in counts.columns if c != "n"]
    both = counts.unionByName(read_segments(spark, path, state.get("segments", []), counts.schema))
    segment = write_segment(both.groupBy(*keys).agg(F.sum("n").alias("n")), path, batch_id)
    manifest.commit(spark, path, number, {"owner": owner, "batch": batch_id, "segments": [segment], "folders": [segment["folder"]]})


def start(stream: DataFrame, write: Callable[..., None], path: str, checkpoint: str, mode: str, available_now: bool) -> StreamingQuery:
    """Hand every micro-batch to ``write``. ``available_now`` stops at the end of the present input."""
    spark = stream.sparkSession
    check_owner(spark, path, checkpoint_id(spark, checkpoint))
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(lambda df, batch_id: write(df, batch_id, path, owner=checkpoint_id(spark, checkpoint))).start()


def start_sink(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", available_now: bool = True, change: Change | None = None) -> StreamingQuery:
    """Append every micro-batch, or what ``change`` makes of it: that may join and aggregate as it could not in a stream."""
    return start(stream, lambda df, *a, **k: write_batch(change(df) if change else df, *a, **k), path, checkpoint, mode, available_now)


def start_unique(stream: DataFrame, key: str, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append the first row of every ``key`` over all batches, however far apart. The stream itself keeps no state."""
    return start(stream, lambda df, *a, **k: write_new_keys(df, *a, key=key, **k), path, checkpoint, "append", available_now)


def start_merge(stream: DataFrame, count: Change, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep running totals of ``count``, which turns a batch into rows of keys and ``n``."""
    return start(stream, lambda df, *a, **k: merge_batch(count(df), *a, **k), path, checkpoint, "append", available_now)


def read_sink(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of the committed batches, with the ``batch_id`` that wrote them; no rows before the first batch."""
    return read_segments(spark, path, manifest.latest(spark, path)[1].get("segments", []), with_batch(schema))


def read_totals(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest totals; no rows before the first batch."""
    return read_segments(spark, path, manifest.latest(spark, path)[1].get("segments", []), schema)


def run_to_totals(stream: DataFrame, count: Change, base: str) -> DataFrame:
    """Run a stream over its present input and return its totals."""
    path = f"{base}/totals"
    start_merge(stream, count, path, f"{base}/checkpoint").awaitTermination()
    empty = stream.sparkSession.createDataFrame([], stream.schema)
    return read_totals(stream.sparkSession, path, count(empty).schema)


def run_to_table(stream: DataFrame, base: str, mode: str = "append", change: Change | None = None) -> DataFrame:
    """Run a stream over its present input and return what its sink holds. ``base`` keeps sink and checkpoint."""
    path, spark = f"{base}/table", stream.sparkSession
    start_sink(stream, path, f"{base}/checkpoint", mode, change=change).awaitTermination()
    schema = change(spark.createDataFrame([], stream.schema)).schema if change else stream.schema
    return read_sink(spark, path, schema)


def run_to_unique(stream: DataFrame, key: str, base: str) -> DataFrame:
    """Run a stream over its present input and return one row for every key."""
    path = f"{base}/table"
    start_unique(stream, key, path, f"{base}/checkpoint").awaitTermination()
    return read_sink(stream.sparkSession, path, stream.schema)
