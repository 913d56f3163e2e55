"""Stream sources by kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordtide.schemas import TABLES


def kafka_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **extra}


def stream_source(spark: SparkSession, kind: str, schema: str | None = None, path: str | None = None, **options) -> DataFrame:
    """A streaming frame. Kinds: ``kafka``, ``rate``, or a file format read from ``path`` with ``schema``.

    ``kafka`` needs the connector on the class path.
    """
    reader = spark.readStream.format(kind).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def is_folder(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getFileStatus(at).isDirectory()


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000) -> DataFrame:
    """One of the Parquet tables as a stream of its files. A table is a folder of part files, or one file."""
    path, options = f"{folder}/{name}.parquet", {"maxFilesPerTrigger": files_per_batch}
    if not is_folder(spark, path):
        # A stream reads folders; the filter leaves the one file.
        path, options["pathGlobFilter"] = folder, f"{name}.parquet"
    return stream_source(spark, "parquet", TABLES[name], path, **options)
