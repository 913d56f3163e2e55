"""Token ids in files of bit planes.

A file is a run of chunks. A chunk holds up to ``BLOCK`` ids, turned into planes: plane b has bit b of every id, packed
eight to a byte. Planes are compressed one by one with zstandard; planes above the highest used bit are left out. The
index after the chunks has the place and sizes of every plane, and the ids, lengths and first position of the documents:

    "WTPLANE1" | planes of chunk 0 | planes of chunk 1 | ... | index (zstandard JSON) | length of the index, 8 bytes
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.llm.common import attempt_name, fresh_path, map_frames, stage, whole
from wordtide.llm.tokens import WORD_BPE, encoder

MAGIC = b"WTPLANE1"
BLOCK = 1 << 16
# Ids in one file, so that index and file stay small enough for one reading task.
FILE_IDS = 1 << 24
END_ID = 1

MANIFEST = "part BIGINT, file INT, path STRING, n_docs BIGINT, n_ids BIGINT"
DOCS = "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT"


def to_planes(ids: np.ndarray) -> list[bytes]:
    """Bit planes of 32-bit ids, lowest first, up to the highest bit in use."""
    width = int(ids.max()).bit_length() if len(ids) else 0
    octets = ids.astype("<u4").view("u1").reshape(-1, 4).T.copy()
    return [np.packbits(octets[b // 8] & (1 << b % 8), bitorder="little").tobytes() for b in range(width)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    ids = np.zeros(n, "<u4")
    for b, plane in enumerate(planes):
        bits = np.unpackbits(np.frombuffer(plane, "u1"), bitorder="little", count=n)
        ids |= bits.astype("<u4") << np.uint32(b)
    return ids


class PlaneWriter:
    """Writes documents' ids to one file; a chunk is written as soon as it is full."""

    def __init__(self, stream, level: int = 3):
        self.stream, self.pack = stream, zstandard.ZstdCompressor(level)
        self.open, self.held, self.at = [], 0, len(MAGIC)
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.chunks: list[list] = []
        stream.write(MAGIC)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.lengths.append(len(ids))
        self.open.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            ready = np.concatenate(self.open)
            full = len(ready) // BLOCK * BLOCK
            for i in range(0, full, BLOCK):
                self.chunk(ready[i : i + BLOCK])
            self.open, self.held = [ready[full:]], len(ready) - full

    def chunk(self, ids: np.ndarray) -> None:
        planes = [self.pack.compress(x) for x in to_planes(ids)]
        self.chunks.append([self.at, len(ids), [len(x) for x in planes]])
        self.stream.write(b"".join(planes))
        self.at += sum(map(len, planes))

    def close(self) -> tuple[int, int]:
        if self.held:
            self.chunk(np.concatenate(self.open))
        index = {"docs": self.docs, "lengths": self.lengths, "chunks": self.chunks}
        packed = self.pack.compress(json.dumps(index).encode())
        self.stream.write(packed + len(packed).to_bytes(8, "little"))
        return len(self.docs), sum(self.lengths)


def read_index(file) -> dict:
    size = file.size()
    file.seek(size - 8)
    length = int.from_bytes(file.read(8), "little")
    file.seek(size - 8 - length)
    return json.loads(zstandard.ZstdDecompressor().decompress(file.read(length)))


def read_chunk(file, chunk: list) -> np.ndarray:
    """Ids of one chunk. The chunk index makes any position of the file reachable without reading what is before it."""
    at, n, sizes = chunk
    file.seek(at)
    data, planes, begin = file.read(sum(sizes)), [], 0
    for size in sizes:
        planes.append(zstandard.ZstdDecompressor().decompress(data[begin : begin + size]))
        begin += size
    return from_planes(planes, n)


def read_documents(file) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the file, ids) of every document, holding one chunk and one document at a time."""
    index = read_index(file)
    chunks = iter(index["chunks"])
    ready, start = np.zeros(0, "<u4"), 0
    for doc, length in zip(index["docs"], index["lengths"]):
        some = [ready]
        have = len(ready)
        while have < length:
            some.append(read_chunk(file, next(chunks)))
            have += len(some[-1])
        ready = np.concatenate(some) if len(some) > 1 else ready
        yield doc, start, ready[:length]
        ready, start = ready[length:], start + length


def _write(folder: str, tokenizer: str, end: int):
    tail = np.array([end], "<u4").tobytes()

    def run(batches):
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        name, number, stream, writer, path = attempt_name(), 0, None, None, ""
        part = int(name.split("-")[0])

        def done():
            nonlocal number, writer
            counts = writer.close()
            stream.close()
            writer, number = None, number + 1
            return pd.DataFrame([(part, number - 1, path, *counts)], columns=["part", "file", "path", "n_docs", "n_ids"])

        for batch in batches:
            for doc, ids in zip(batch["doc_id"], encoder(tokenizer).encode(batch["text"])):
                if writer is None:
                    path = f"{name}-{number:05d}.planes"
                    stream = files.open_output_stream(f"{base}/{path}", compression=None)
                    writer = PlaneWriter(stream)
                writer.add(None if doc is pd.NA else int(doc), np.frombuffer(ids + tail, "<u4"))
                if sum_over(writer):
                    yield done()
        if writer is not None:
            yield done()

    return run


def sum_over(writer: PlaneWriter) -> bool:
    return writer.chunks and len(writer.chunks) * BLOCK >= FILE_IDS


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = WORD_BPE, end: int = END_ID) -> DataFrame:
    """Writes all texts' ids below ``folder`` in ascending doc_id order, and returns the manifest of the files.

    Only files in the manifest count: Spark commits it, so files of lost or repeated tasks are never read. Ranges of
    doc_id are dealt to tasks before encoding, so the text is shuffled once and ids never are. A NULL id sorts first;
    rows with one id are ordered by text; a NULL text is empty and holds only the end id.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"))
    ordered = texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return stage(map_frames(ordered, _write(folder, tokenizer, end), MANIFEST), "plane-files")


def _read(folder: str):
    def run(batches):
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, first in zip(batch["path"], batch["first"]):
                out = []
                with files.open_input_file(f"{base}/{path}") as file:
                    for doc, start, ids in read_documents(file):
                        out.append((doc, int(first) + start, len(ids), zlib.crc32(ids.tobytes())))
                        if len(out) == 20_000:
                            yield out
                            out = []
                yield out

    return run


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and checksum of every document, from the files alone.

    The files' own counts are added up in the driver: one number per file of at least ``FILE_IDS`` ids or per task.
    """
    spark = manifest.sparkSession
    first, rows = 0, []
    for file in manifest.orderBy("part", "file").collect():
        rows.append((file["path"], first))
        first += file["n_ids"]
    listed = spark.createDataFrame(rows, "path STRING, first BIGINT")
    return map_frames(listed.repartition(max(1, len(rows)), "path"), _read(folder), DOCS)


def token_files(docs: DataFrame, folder: str | None = None, tokenizer: str = WORD_BPE) -> DataFrame:
    """Write and read back; an empty table gives no files and no rows. Other columns are not read."""
    folder = folder or fresh_path(docs.sparkSession, "planes")
    return read_token_files(write_token_files(docs, folder, tokenizer), folder)
