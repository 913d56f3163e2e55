"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wordtide.session import fresh_path, shared_folder, stage

__all__ = ["attempt_name", "bound_batches", "by_batch", "free_name", "fresh_path", "give_back", "let", "likely", "likely_in", "map_frames", "shared_folder", "stage", "table", "whole"]


# Rows and bytes of whole texts that a Python worker is handed at once. Spark's defaults suit short rows.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def bound_batches(spark: SparkSession) -> SparkSession:
    """Let Python workers see few texts at a time, so that their memory depends on one batch and the longest text."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as make it unlike all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole(text: str = "text") -> Column:
    """The text, a NULL taken as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


# Bits of the map of hashed keys, of 4 MB: at five million keys one in seven others passes it.
KEY_BITS = 1 << 25


def likely(rows: DataFrame, keys: DataFrame, key: str, name: str, bits: int = KEY_BITS) -> DataFrame:
    """``rows`` with a boolean column ``name``: true if ``key`` is among those of ``keys``, and for a few others, by a broadcast
    map of hashed keys. Whatever the number of keys, the map has ``bits`` bits at most."""
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    bucket, held = free_name(rows, "_bucket"), free_name(rows, "_bits")
    at = F.bitmap_bit_position(place)
    taken = keys.groupBy(F.bitmap_bucket_number(place).alias(bucket)).agg(F.bitmap_construct_agg(at).alias(held))
    octet = F.conv(F.hex(F.substring(held, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    both = rows.withColumn(bucket, F.bitmap_bucket_number(place)).join(F.broadcast(taken), bucket, "left")
    return both.select(*rows.columns, F.coalesce(F.getbit(octet, (at % 8).cast("int")) == 1, F.lit(False)).alias(name))


def likely_in(rows: DataFrame, keys: DataFrame, key: str, bits: int = KEY_BITS) -> DataFrame:
    """The rows that ``likely`` marks. It spares a join the shuffle of rows that it would drop."""
    name = free_name(rows, "_likely")
    return likely(rows, keys, key, name, bits).where(name).select(*rows.columns)


def by_batch(rows: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function of one Arrow batch, in the form that ``mapInPandas`` takes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield rows(batch)

    return run


# Whole numbers stay whole next to a NULL; pandas' own choice would be fractions, which change ids beyond 2**53.
EXACT = {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}


def map_frames(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame | list[tuple]]], schema: str) -> DataFrame:
    """``mapInPandas`` that keeps every id as it is. ``df`` should hold only the columns that are read.

    ``run`` gives frames, or lists of rows: a frame made of rows would turn ids next to None into fractions.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in run(batch.to_pandas(types_mapper=EXACT.get) for batch in batches):
            if not len(frame):
                continue
            if isinstance(frame, list):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*frame), arrow)], schema=arrow)
            else:
                yield pa.RecordBatch.from_pandas(frame, schema=arrow, preserve_index=False)

    return df.mapInArrow(batches_of, schema)


def give_back() -> None:
    """Return memory that a Python worker has freed, as the worker lives on and serves other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def attempt_name() -> str:
    """A name that no other attempt of a task has, so that a repeated task never writes to the same file."""
    at = TaskContext.get()
    return f"{at.partitionId():06d}-{at.taskAttemptId()}" if at else "000000-0"
