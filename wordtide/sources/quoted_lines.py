"""Records of CSV files whose quoted fields hold line breaks, read by many tasks for each file.

A line begins a record if the quotes before it are even in number. So the first pass counts quotes by split, and the
running sum over a file's splits tells each of them whether it begins inside a field. The second pass puts lines together
inside each split. Where a record reaches over the end of a split its parts are few, and are joined by a shuffle.

Quotes must stand around a field or be doubled inside one, as RFC 4180 has it and ``posts_csv.write_posts`` writes them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PART = "file BIGINT, block BIGINT, is_end BOOLEAN, record BINARY"


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines in the files' order within each split: file (a hash of its path), block (where its split begins), line."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"), "_metadata.file_path"
    )


def open_splits(lines: DataFrame) -> dict[tuple[int, int], bool]:
    """The splits (file, block) with a quoted field open at one of their ends, and whether it is open at the beginning.

    At most one entry for each split, a hundred bytes for every ``spark.sql.files.maxPartitionBytes`` of input, so the
    whole is a millionth of the data.
    """
    quotes = F.length("line") - F.length(F.replace(F.col("line").cast("string"), F.lit('"'), F.lit("")).cast("binary"))
    blocks = lines.groupBy("file", "block").agg(F.sum(quotes).alias("n"), F.min("file_path").alias("a"), F.max("file_path").alias("z"))
    upto = F.sum("n").over(Window.partitionBy("file").orderBy("block"))
    mixed = F.col("a") != F.col("z")
    odd = blocks.select("file", "block", mixed.alias("mixed"), (upto % 2 == 1).alias("ends"), ((upto - F.col("n")) % 2 == 1).alias("begins"))
    found = odd.where("mixed OR begins OR ends").collect()
    if any(r.mixed for r in found):
        raise ValueError("two file paths have one hash: read them apart")
    return {(r.file, r.block): r.begins for r in found}


class Assembler:
    """Lines of one split to records. What belongs to a record begun before or ended after it is kept apart."""

    def __init__(self, inside: bool):
        self.odd = inside
        # Lines of the record that is not at its end yet; the first one of a split may have begun before it.
        self.open: list[bytes] = []
        self.head = inside

    def add(self, lines: pa.Array) -> tuple[list[pa.Array], list[bytes]]:
        """Whole records, and the end of a record that was begun in an earlier split."""
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)
        after = (np.cumsum(quotes) + self.odd) & 1
        ends = np.flatnonzero(after == 0)
        heads: list[bytes] = []
        done: list[pa.Array] = []
        first = 0
        if len(ends) and (self.open or self.head):
            first = int(ends[0]) + 1
            record = b"\n".join([*self.open, *lines.slice(0, first).to_pylist()])
            if self.head:
                heads.append(record)
            else:
                done.append(pa.array([record], pa.binary()))
            self.open, self.head = [], False
        if len(ends):
            begins = np.concatenate([[first], ends[ends >= first][:-1] + 1]) if (ends >= first).any() else np.zeros(0, np.int64)
            stops = ends[ends >= first] + 1
            alone = stops - begins == 1
            if alone.any():
                done.append(lines.take(pa.array(begins[alone])))
            several = [b"\n".join(lines.slice(a, b - a).to_pylist()) for a, b in zip(begins[~alone].tolist(), stops[~alone].tolist())]
            if several:
                done.append(pa.array(several, pa.binary()))
            first = int(ends[-1]) + 1
        self.open += lines.slice(first).to_pylist()
        self.odd = bool(after[-1]) if len(after) else self.odd
        return done, heads


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """Stretches of lines of one split, in their order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield (int(file[a]), int(block[a])), batch.column(2).slice(a, b - a)


def assemble(opened, wanted: str):
    """``records``: whole records of each split. ``parts``: what a split has of records that reach over its ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, split = None, None

        def parts(heads: list[bytes], tail: list[bytes]) -> Iterator[pa.RecordBatch]:
            rows = [(False, h) for h in heads]
            if tail:
                # A split that lies inside one field as a whole has no end and no beginning: it is a middle part.
                rows.append((not split.head, b"\n".join(tail)))
            if rows and wanted == "parts":
                ends, records = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at[0]] * len(rows)), pa.array([at[1]] * len(rows)), pa.array(ends), pa.array(records, pa.binary())], ["file", "block", "is_end", "record"]
                )

        for place, lines in runs(batches):
            if wanted == "parts" and place not in opened.value:
                continue
            if place != at:
                if split:
                    yield from parts([], split.open)
                at, split = place, Assembler(opened.value.get(place, False))
            done, heads = split.add(lines)
            yield from parts(heads, [])
            if wanted == "records":
                for records in done:
                    yield pa.RecordBatch.from_arrays([records], ["record"])
        if split:
            yield from parts([], split.open)

    return run


def join_parts(parts: DataFrame) -> DataFrame:
    """Records from their parts: each begins with the end of one split, and goes on over the beginnings of the next.

    ``is_end`` marks a part that begins a record. There are two parts for a split at most.
    """
    order = Window.partitionBy("file").orderBy("block", "is_end")
    numbered = parts.withColumn("number", F.sum(F.col("is_end").cast("bigint")).over(order))
    pieces = F.sort_array(F.collect_list(F.struct("block", "is_end", F.hex("record").alias("hex"))))
    whole = numbered.groupBy("file", "number").agg(pieces.alias("pieces"))
    return whole.select(F.unhex(F.array_join(F.transform("pieces", lambda p: p["hex"]), "0A")).alias("record"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the raw bytes of every record, without the line end. Empty lines outside of fields are left out.

    A file that ends inside a field has all lines since that field's quote in its last record.
    """
    lines = split_lines(spark, path)
    opened = spark.sparkContext.broadcast(open_splits(lines))
    lines = lines.select("file", "block", "line")
    records = lines.mapInArrow(assemble(opened, "records"), "record BINARY")
    if opened.value:
        records = records.unionByName(join_parts(lines.mapInArrow(assemble(opened, "parts"), PART)))
    # A record of a single line keeps the first half of a Windows line end.
    bare = F.when(F.endswith("record", F.lit(b"\r")), F.expr("substring(record, 1, octet_length(record) - 1)")).otherwise(F.col("record"))
    return records.select(bare.alias("record")).where(F.octet_length("record") > 0)
