"""Session settings and the shared folder that staged tables are written to."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. They are SQL settings, so they can be
# put on a session somebody else started.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "wordtide", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Start a session. Deployment settings (memory, cores, master) come from ``conf`` or spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is made only for local masters; on a cluster a missing setting is an error,
    because a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wordtide-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so several passes can reuse it.

    Unlike a cache, the written table survives the loss of executors and cuts the lineage.
    """
    path = fresh_path(df.sparkSession, name)
    write_once(df, path, *partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_once(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write ``df`` to a new ``path``, and drop what writing it has shuffled.

    Nothing else reads that; Spark would keep it until the driver collects its garbage.
    """
    conf = df.sparkSession.conf
    kept = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        conf.set(CLEANUP, kept)
