"""WARC archives: from one gzip stream for a whole file to one gzip member for each record, with an offset index.

The normaliser inflates a monolithic archive once, as a stream, and writes every record as a member of its own, so that
any record can be read by its offset alone. The sidecar index is a Parquet table of the records' files and offsets.

Tasks write to names of their own attempt. What counts is listed in tables that Spark commits, so files of lost or
repeated tasks are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.llm.common import attempt_name, fresh_path, let, map_frames, stage, whole

# Bytes of records in one archive; a larger record has an archive of its own.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
GZIP = 31

ARCHIVES = "archive STRING, records BIGINT, bytes BIGINT"
INDEX = "archive STRING, file STRING, offset BIGINT, length BIGINT, record_type STRING, page_id BIGINT"
RECORDS = "page_id BIGINT, payload_bytes BIGINT, payload_digest STRING, record_type STRING, refers_to BIGINT"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit has no payload; the size of what it stands for is in a header."""
    kind = "response" if refers_to is None else "revisit"
    header = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Target-URI: {_one_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if refers_to is not None:
        header += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
        payload = b""
    header.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(header).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _one_line(url: str | None) -> str:
    """A header ends at its line's end, so line ends of an address are written as escapes."""
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m.group()):02X}", url or "")


def parse_header(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:60]}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def inflate(file) -> Iterator[bytes]:
    """Inflated bytes of a gzip file, a chunk at a time. Several members, one after the other, are read as one stream.

    A stream without its end is an error, even where it breaks off between two records.
    """
    unpack, data, begun = zlib.decompressobj(GZIP), b"", False
    while True:
        data = data or file.read(CHUNK)
        if not data:
            break
        while data:
            yield unpack.decompress(data, CHUNK)
            data, begun = unpack.unconsumed_tail, True
            if unpack.eof:
                data, unpack, begun = unpack.unused_data, zlib.decompressobj(GZIP), False
    yield unpack.flush()
    if begun and not unpack.eof:
        raise ValueError("the gzip stream breaks off")


def split_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream, holding no more than one record and one chunk."""
    held = bytearray()

    def need(n: int) -> bool:
        while len(held) < n:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while need(1):
        end, looked = -1, 0
        while end < 0:
            end = held.find(b"\r\n\r\n", max(0, looked - 3))
            looked = len(held)
            if end < 0 and not need(looked + 1):
                raise ValueError("the stream ends inside a header")
        size = end + 4 + int(parse_header(bytes(held[:end]))["content-length"]) + 4
        if not need(size):
            raise ValueError("the stream ends inside a record")
        yield bytes(held[:size])
        del held[:size]


def with_references(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html and refers_to: the page whose equal payload of at least ``least`` bytes is kept.

    Digests alone are grouped, folded before the shuffle. Pages are then joined to them by a hash of payload and id, so
    a payload that very many pages share is spread over tasks.
    """
    text = whole("html")
    keys = pages.select(F.col("page_id").cast("bigint"), let(text, lambda t: F.struct(F.sha1(t).alias("digest"), F.octet_length(t).alias("size"))).alias("x")).select("page_id", "x.*")
    shared = keys.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = stage(shared.where("n > 1").select("digest", "first"), "shared-payloads")
    revisits = keys.join(shared, "digest").where("page_id <> first").select("page_id", "digest", F.col("first").alias("refers_to")).distinct()
    revisits = stage(revisits, "revisits")
    full = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), text.alias("html"))
    keyed = full.withColumn("digest", F.sha1("html"))
    return keyed.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")


def _write(folder: str, level: int):
    def run(batches):
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        name, number, stream, pack, path, records, size = attempt_name(), 0, None, None, "", 0, 0

        def done():
            nonlocal stream, number
            stream.write(pack.flush())
            stream.close()
            stream, number = None, number + 1
            return pd.DataFrame([(path, records, size)], columns=["archive", "records", "bytes"])

        for batch in batches:
            for page, url, html, to in zip(batch["page_id"], batch["url"], batch["html"], batch["refers_to"]):
                payload = html.encode()
                page, to = (None if x is pd.NA else int(x) for x in (page, to))
                record = record_bytes(page, url, payload, len(payload), base32_sha1(payload), to)
                if stream is not None and size + len(record) > ARCHIVE_BYTES:
                    yield done()
                if stream is None:
                    path, records, size = f"{name}-{number:05d}.warc.gz", 0, 0
                    stream, pack = files.open_output_stream(f"{base}/{path}", compression=None), zlib.compressobj(level, zlib.DEFLATED, GZIP)
                stream.write(pack.compress(record))
                records, size = records + 1, size + len(record)
        if stream is not None:
            yield done()

    return run


def write_monolithic(pages: DataFrame, folder: str, least: int = 0, level: int = 1) -> DataFrame:
    """Archives of one gzip stream each; returns the written table of archives."""
    return stage(map_frames(with_references(pages, least), _write(folder, level), ARCHIVES), "archives")


def _normalise(source: str, target: str, level: int):
    def run(batches):
        files, base = pyarrow.fs.FileSystem.from_uri(source)
        out, to = pyarrow.fs.FileSystem.from_uri(target)
        out.create_dir(to, recursive=True)
        for batch in batches:
            for k, (archive, records) in enumerate(zip(batch["archive"], batch["records"])):
                file, offset, rows, seen = f"{attempt_name()}-{k:05d}-{archive}", 0, [], 0
                with files.open_input_stream(f"{base}/{archive}", compression=None) as stream, out.open_output_stream(f"{to}/{file}", compression=None) as into:
                    for record in split_records(inflate(stream)):
                        head = parse_header(record[: record.index(b"\r\n\r\n")])
                        pack = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                        member = pack.compress(record) + pack.flush()
                        into.write(member)
                        rows.append((archive, file, offset, len(member), head["warc-type"], page_of(head.get("warc-record-id"))))
                        offset, seen = offset + len(member), seen + 1
                        if len(rows) == 50_000:
                            yield rows
                            rows = []
                if seen != records:
                    raise ValueError(f"{archive} has {seen} records and not {records}")
                yield rows

    return run


def normalise(archives: DataFrame, source: str, target: str, level: int = 6) -> DataFrame:
    """Rewrites every archive below ``source`` to ``target`` and returns the written sidecar index.

    One task takes one archive, whatever its size, as a gzip stream can only be read from its start.
    """
    n = max(1, archives.count())
    return stage(map_frames(archives.select("archive", "records").repartition(n, "archive"), _normalise(source, target, level), INDEX), "warc-index")


def _read(folder: str):
    def run(batches):
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = []
            for name, part in batch.groupby("file", sort=False):
                with files.open_input_file(f"{base}/{name}") as file:
                    for offset, length in zip(part["offset"], part["length"]):
                        file.seek(int(offset))
                        record = zlib.decompress(file.read(int(length)), GZIP)
                        at = record.index(b"\r\n\r\n")
                        head, payload = parse_header(record[:at]), record[at + 4 : -4]
                        digest = head["warc-payload-digest"].removeprefix("sha1:")
                        if head["warc-type"] == "response" and digest != base32_sha1(payload):
                            raise ValueError(f"digest of {name} at {offset} does not fit")
                        rows.append((page_of(head["warc-record-id"]), int(head["x-payload-length"]), digest, head["warc-type"], page_of(head.get("warc-refers-to"))))
            yield rows

    return run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every indexed record, read by its offset."""
    return map_frames(index.select("file", "offset", "length"), _read(folder), RECORDS)


def warc_round_trip(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write, normalise and read back.

    Of equal payloads of at least ``least`` bytes, the smallest page_id is the response and the others revisit it. A
    NULL html is empty. Rows that repeat a page with its payload are responses or revisits alike, as the page is. A
    page without an id is a response of its own and stands for no other. An empty table gives no archives and no rows.
    """
    folder = folder or fresh_path(pages.sparkSession, "warc")
    archives = write_monolithic(pages, f"{folder}/monolithic", least)
    index = normalise(archives, f"{folder}/monolithic", f"{folder}/members")
    return read_records(index, f"{folder}/members")
