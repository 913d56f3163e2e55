"""Tables that change in one step: data folders that nobody reads until a manifest names them.

A writer puts its files into folders of its own and then commits a numbered manifest, a small JSON file that names all
folders of the new state. The file gets its number by a rename that fails if the number is taken, so there is one next
state, whole or not at all. Readers take the manifest with the highest number.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import SparkSession

# Manifests whose folders stay, for readers that have begun with an older state.
KEPT = 3
COMMITS = "_commits"


class Taken(Exception):
    """Another writer has committed the number first."""


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as executors and driver see it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A file with all of ``text`` at ``path``; fails if there is one."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    files, draft = hadoop_path(spark, f"{path}.{uuid4().hex}.draft")
    out = files.create(draft)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    none = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, hadoop_path(spark, path)[1], none)
    except Exception as failure:
        files.delete(draft, False)
        if "FileAlreadyExists" in str(failure):
            raise Taken(path) from failure
        raise


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is none."""
    files, at = hadoop_path(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def numbers(spark: SparkSession, base: str) -> list[int]:
    files, pattern = hadoop_path(spark, f"{base}/{COMMITS}/*.json")
    return sorted(int(s.getPath().getName().split(".")[0]) for s in files.globStatus(pattern) or [])


def manifest_path(base: str, number: int) -> str:
    return f"{base}/{COMMITS}/{number:020d}.json"


def read_manifest(spark: SparkSession, base: str, number: int) -> dict:
    return json.loads(read_text(spark, manifest_path(base, number)))


def latest(spark: SparkSession, base: str) -> tuple[int, dict]:
    """The newest state and its number; (-1, {}) before the first commit."""
    known = numbers(spark, base)
    return (known[-1], read_manifest(spark, base, known[-1])) if known else (-1, {})


def new_folder(base: str) -> str:
    """A folder, relative to ``base``, that no other writer or attempt uses."""
    return f"data/{uuid4().hex}"


def commit(spark: SparkSession, base: str, after: int, state: dict, kept: int = KEPT) -> int:
    """Make ``state`` the one after number ``after``. Its ``folders`` are those that its readers need.

    Folders that only manifests older than the last ``kept`` name are deleted with those manifests.
    """
    write_once(spark, manifest_path(base, after + 1), json.dumps(state))
    known = numbers(spark, base)
    old = {n: read_manifest(spark, base, n) for n in known[:-kept]}
    if old:
        used = {f for n in known[-kept:] for f in read_manifest(spark, base, n)["folders"]}
        for number, manifest in old.items():
            for folder in set(manifest["folders"]) - used:
                delete(spark, f"{base}/{folder}")
            delete(spark, manifest_path(base, number))
    return after + 1


def delete(spark: SparkSession, path: str) -> None:
    files, at = hadoop_path(spark, path)
    files.delete(at, True)


def size_of(spark: SparkSession, path: str) -> int:
    files, at = hadoop_path(spark, path)
    return files.getContentSummary(at).getLength()
