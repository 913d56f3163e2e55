"""WARC round trips and the corpus pipeline."""

import base64
import hashlib
import io
import random
import zlib

import corpus_pipeline
import pytest
from conftest import rows
from pyspark.sql import functions as F

from wordtide.llm import warc


def test_streams_are_split_into_records():
    rng = random.Random(1)
    records = [warc.record_bytes(i, f"u{i}", p, len(p), "X", None) for i, p in enumerate([b"", b"\r\n\r\n", rng.randbytes(3_000_000), b"x" * 7, "é".encode()])]
    pack = zlib.compressobj(1, zlib.DEFLATED, warc.GZIP)
    stream = b"".join(map(pack.compress, records)) + pack.flush()
    assert list(warc.split_records(warc.inflate(io.BytesIO(stream)))) == records
    # An archive of several members is read alike.
    import gzip

    members = b"".join(map(gzip.compress, records))
    assert list(warc.split_records(warc.inflate(io.BytesIO(members)))) == records
    with pytest.raises(ValueError):
        list(warc.split_records(iter([records[2][:-10]])))


def test_a_stream_that_breaks_off_is_an_error(spark, tmp_path, monkeypatch):
    records = [warc.record_bytes(i, "u", b"x" * 2000, 2000, "X", None) for i in range(50)]
    pack = zlib.compressobj(1, zlib.DEFLATED, warc.GZIP)
    stream = b"".join(pack.compress(r) + pack.flush(zlib.Z_FULL_FLUSH) for r in records)
    # All of the bytes are there, but not the end of the stream.
    with pytest.raises(ValueError, match="breaks off"):
        list(warc.split_records(warc.inflate(io.BytesIO(stream))))
    pages = spark.createDataFrame([(i, "u", f"p{i}") for i in range(20)], "page_id long, url string, html string")
    archives = warc.write_monolithic(pages, f"file://{tmp_path}/a")
    wrong = archives.withColumn("records", F.col("records") + 1)
    with pytest.raises(Exception, match="records and not"):
        warc.normalise(wrong, f"file://{tmp_path}/a", f"file://{tmp_path}/b")


@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, tmp_path, least, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4_000)
    pages = [(1, "http://a", "<p>same</p>"), (2, None, None), (3, "http://b\r\nX: y", ""), (4, "u", "<p>same</p>"), (5, "u", "x" * 50_000), (5, "u", "x" * 50_000),
             (6, "u", "ab"), (7, "u", "ab"), (None, "u", "<p>same</p>"), (9, "u", "ünï \U0001f600 \r\n\r\n WARC/1.1")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "'y' AS first", "1 AS refers_to").repartition(2)
    first, want = {}, []
    for page, _, html in pages:
        payload = (html or "").encode()
        if page is not None and len(payload) >= least:
            first[payload] = min(page, first.get(payload, page))
    for page, _, html in pages:
        payload = (html or "").encode()
        to = first.get(payload, page) if page is not None else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((page, len(payload), digest, "response" if to == page else "revisit", None if to == page else to))
    assert rows(warc.warc_round_trip(frame, f"file://{tmp_path}/w", least)) == sorted(want, key=repr)
    members = list((tmp_path / "w/members").iterdir())
    assert len(members) > 2
    assert warc.warc_round_trip(frame.where("false")).count() == 0


def test_stages_keep_columns_and_rows_that_are_clean(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").selectExpr("*", "'kept' AS _digest", "1 AS score")
    counts = [docs.count()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small)
        out.write.parquet(f"{tmp_path}/{number}")
        out = spark.read.parquet(f"{tmp_path}/{number}")
        if name != "packing":
            assert out.columns == docs.columns
            counts.append(out.count())
            docs = out
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    first = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/0").collect()}
    assert sum(labels[i] == 0 and i not in first for i in labels) <= 2
    assert counts == sorted(counts, reverse=True) and counts[3] == counts[4]
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
    assert docs.where("text RLIKE 'token = .[0-9a-f]{40}'").count() == 0


def test_empty_tables_go_through(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("false")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
    assert docs.count() == 0
