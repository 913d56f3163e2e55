"""Sources, sinks and streams."""

import functools
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wordtide.fixed_values import FEED_SOURCES, MESSAGE_TEXTS
from wordtide.plans import live
from wordtide.session import fresh_path
from wordtide.sources import manifest, messages, posts_csv, sinks, tables
from wordtide.sources.quoted_lines import read_records, split_lines
from wordtide.streaming import scoring
from wordtide.streaming import sinks as stream_sinks
from wordtide.streaming.sources import kafka_options, stream_source, stream_table

LINES = (
    '"0","1","d","q","u","plain text"\n'
    '"4","2","d","q","u","say ""hi"", you \\"\n'
    '"x","3","d","q","u","bad polarity"\n'
    '"4","4","d","q"\n'
    '"2","5","d","q","u","other"\n'
    '"4","6","d","q","u",""\n'
)


def test_csv_fields_and_quotes(spark, tmp_path):
    (tmp_path / "p.csv").write_text(LINES)
    got = {r["id"]: r for r in posts_csv.read_posts(spark, str(tmp_path)).collect()}
    assert got["2"]["text"] == 'say "hi", you \\'
    assert got["3"]["polarity"] is None and got["4"]["text"] is None
    assert (got["1"]["polarity"], got["1"]["text"]) == (0, "plain text")


def test_csv_encoding_is_a_parameter(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes('"0","1","d","q","u","café"\n'.encode("latin-1"))
    assert posts_csv.read_posts(spark, str(tmp_path), "ISO-8859-1").first()["text"] == "café"
    assert posts_csv.read_posts(spark, str(tmp_path)).first()["text"] == "caf\ufffd"


def test_csv_roundtrip_of_awkward_text(spark, tmp_path):
    texts = ['a "q" b', " lead", "trail ", "line\nbreak", "cr\r\nlf", "comma, here", "back\\slash", '\\"', "'", "ü"]
    df = spark.createDataFrame([(4, str(i), "d", "q", "u", t) for i, t in enumerate(texts)], posts_csv.POSTS_CSV)
    posts_csv.write_posts(df, str(tmp_path / "out"))
    back = posts_csv.read_posts(spark, str(tmp_path / "out"), multi_line=True)
    assert rows(back) == rows(df)


AWKWARD = ['a "q" b', " lead", "line\nbreak", "cr\r\nlf", "comma, here", "back\\slash", '\\"', "ü", "\n", "\r\n\r\n", '"', '""\n""', "x\r", "漢\n字"]


@pytest.fixture
def small_splits(spark):
    """A function that sets the size of splits, for the time of one test."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}

    def set_size(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 1)

    yield set_size
    for name, value in before.items():
        spark.conf.set(name, value)


def whole_file_reader(spark, path):
    return spark.read.schema(posts_csv.POSTS_CSV).option("escape", '"').option("multiLine", True).csv(path)


@pytest.mark.parametrize("size", [60, 700, 20_000])
def test_line_breaks_in_fields_are_read_by_many_tasks(spark, tmp_path, small_splits, size):
    random.seed(size)
    posts = [(random.choice([0, 4, None]), str(i), "d", "q", None, "".join(random.choices(AWKWARD, k=random.randrange(1, 6)))) for i in range(150)]
    posts.append((4, "long", "d", "q", "u", "one field,\n over many splits\r\n" * 40))
    path = str(tmp_path / "one")
    written = spark.createDataFrame(posts, posts_csv.POSTS_CSV)
    posts_csv.write_posts(written.coalesce(1), path)
    small_splits(size)
    # Windows line ends inside fields stay, which Spark's own reader sometimes replaces.
    assert rows(posts_csv.read_posts(spark, path, multi_line=True)) == rows(written)
    if size < 20_000:
        assert split_lines(spark, path).rdd.getNumPartitions() > 8


def test_parallel_reader_treats_odd_files_as_the_other_does(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text(LINES)
    (tmp_path / "b.csv").write_bytes(LINES.replace("\n", "\r\n").encode())
    (tmp_path / "c.csv").write_bytes(b'"4","9","d","q","u","no line end"')
    (tmp_path / "d.csv").write_bytes(b"\n\n0,10,d,q,u,unquoted text\n \n")
    (tmp_path / "e.csv").write_bytes(b"")
    for size in (40, 1000):
        small_splits(size)
        assert rows(posts_csv.read_posts(spark, str(tmp_path), multi_line=True)) == rows(whole_file_reader(spark, str(tmp_path)))


def test_parallel_reader_keeps_an_open_field_to_the_end(spark, tmp_path, small_splits):
    (tmp_path / "p.csv").write_text('"4","1","d","q","u","fine"\n"4","2","d","q","u","open\nto the\nend')
    for size in (10, 1000):
        small_splits(size)
        records = [r.record for r in read_records(spark, str(tmp_path)).collect()]
        assert sorted(map(bytes, records)) == [b'"4","1","d","q","u","fine"', b'"4","2","d","q","u","open\nto the\nend']


def test_parallel_reader_decodes(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes('"0","1","d","q","u","ca\nfé"\n'.encode("latin-1"))
    assert posts_csv.read_posts(spark, str(tmp_path), "ISO-8859-1", multi_line=True).first()["text"] == "ca\nfé"
    assert posts_csv.read_posts(spark, str(tmp_path), multi_line=True).first()["text"] == "ca\nf\ufffd"


def test_lines_split_five_times_and_quarantine(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes(LINES.replace("plain", "é, plain").encode("latin-1"))
    lines = posts_csv.read_lines(spark, str(tmp_path))
    good, bad = posts_csv.split_lines(lines)
    assert rows(good.select("polarity", "id", "text")) == [(0, "1", "é, plain text"), (4, "2", "say hi, you \\")]
    assert sorted(r.reason for r in bad.collect()) == ["bad_polarity", "empty_text", "too_few_fields", "unknown_polarity"]
    first_part = lines.select(posts_csv.sixth_field(F.col("value"))).first()[0]
    assert first_part == '"é'


def test_synthetic_rows(spark):
    feed = messages.synthetic_feed(spark, {"a": 3, "b": 2})
    assert rows(feed) == [
        (0, "a", "tweet from a #1", "a_1"), (0, "b", "tweet from b #1", "b_1"), (4, "a", "tweet from a #0", "a_0"),
        (4, "a", "tweet from a #2", "a_2"), (4, "b", "tweet from b #0", "b_0"),
    ]
    assert messages.synthetic_feed(spark).count() == sum(FEED_SOURCES.values())
    sent = messages.synthetic_messages(spark, 50)
    assert {r.text for r in sent.collect()} == set(MESSAGE_TEXTS)
    assert sent.where(~F.col("user").rlike("^user_([1-9][0-9]?|100)$")).count() == 0


def test_union_sources_fills_missing_columns(spark):
    union = tables.union_sources({"x": spark.range(1).withColumn("t", F.lit("a")), "y": spark.range(1)})
    assert rows(union) == [(0, "a", "x"), (0, None, "y")]


def test_broken_json_becomes_null(spark):
    raw = spark.createDataFrame([(b"{oops",), (b'{"text": "ok", "extra": 1}',)], "value BINARY")
    assert rows(messages.parse(raw)) == [("ok", None, None), (None, None, None)]


def test_publish_replaces(spark, tmp_path):
    for n in (3, 2):
        paths = sinks.publish(spark, str(tmp_path), table=spark.range(n))
    assert spark.read.parquet(paths["table"]).count() == sinks.published(spark, str(tmp_path))["table"].count() == 2


def test_a_failure_between_two_tables_leaves_the_old_set(spark, tmp_path):
    base = str(tmp_path)
    assert sinks.published(spark, base) == {}
    sinks.publish(spark, base, a=spark.range(3), b=spark.range(4))
    before = sinks.published(spark, base)
    broken = spark.range(9).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(spark, base, a=spark.range(7), b=broken)
    for found in (before, sinks.published(spark, base)):
        assert {name: df.count() for name, df in found.items()} == {"a": 3, "b": 4}
    sinks.publish(spark, base, a=spark.range(7), c=spark.range(1))
    assert {name: df.count() for name, df in sinks.published(spark, base).items()} == {"a": 7, "c": 1}
    assert {name: df.count() for name, df in before.items()} == {"a": 3, "b": 4}, "a reader that has begun goes on"


def test_old_sets_are_deleted(spark, tmp_path):
    for n in range(6):
        sinks.publish(spark, str(tmp_path), a=spark.range(n), b=spark.range(1))
    assert len(list((tmp_path / "data").iterdir())) == 2 * manifest.KEPT
    assert manifest.numbers(spark, str(tmp_path)) == [3, 4, 5]


def test_one_number_is_committed_once(spark, tmp_path):
    base = str(tmp_path)
    assert manifest.latest(spark, base) == (-1, {})
    assert manifest.commit(spark, base, -1, {"folders": [], "by": 1}) == 0
    with pytest.raises(manifest.Taken):
        manifest.commit(spark, base, -1, {"folders": [], "by": 2})
    assert manifest.latest(spark, base) == (0, {"folders": [], "by": 1})
    assert not [p for p in (tmp_path / "_commits").iterdir() if "draft" in p.name and not p.name.startswith(".")]


def test_two_writers_are_published_one_after_the_other(spark, tmp_path, monkeypatch):
    base, real, calls = str(tmp_path), manifest.latest, []

    def late(spark, path):
        found = real(spark, path)
        if not calls:
            calls.append(1)
            sinks.publish(spark, base, a=spark.range(2))
        return found

    monkeypatch.setattr(manifest, "latest", late)
    sinks.publish(spark, base, a=spark.range(5))
    assert manifest.numbers(spark, base) == [0, 1] and sinks.published(spark, base)["a"].count() == 5


def test_land_raw_reconciles(spark, small, tmp_path):
    row = sinks.land_raw(spark, tables.read_table(spark, small, "labels"), str(tmp_path), "labels").first()
    assert row.n == row.landed == tables.read_table(spark, small, "labels").count()


def test_spread_only_when_there_are_few_splits(spark, small):
    docs = tables.documents(spark, small)
    cores = spark.sparkContext.defaultParallelism
    assert tables.spread(docs, "id").rdd.getNumPartitions() == cores
    wide = docs.repartition(cores * 2)
    assert tables.spread(wide, "id") is wide


# Streams


def test_kafka_options():
    assert kafka_options("h:1", "t", startingOffsets="earliest") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
    }


def message_files(spark, folder, texts, part):
    values = [(t, f"user_{i}", f"2024-01-0{1 + i % 3} 10:00:00") for i, t in enumerate(texts)]
    df = spark.createDataFrame(values, "text STRING, user STRING, timestamp STRING")
    messages.encode(df, "text", "user", "timestamp").coalesce(1).write.parquet(f"{folder}/part={part}")


def raw_stream(spark, folder):
    return stream_source(spark, "parquet", "value BINARY", f"{folder}/*")


def run_live(spark, folder, out):
    for query in live.start_all(raw_stream(spark, folder), out, available_now=True).values():
        query.awaitTermination()


def test_live_job_quarantines_counts_and_resumes(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    message_files(spark, folder, ["love", "bad", None, "so so"], 1)
    run_live(spark, folder, out)

    def table(name):
        return stream_sinks.read_sink(spark, f"{out}/{name}", spark.createDataFrame([], "text STRING, value STRING").schema)

    def totals(name, schema):
        return stream_sinks.read_totals(spark, f"{out}/{name}", spark.createDataFrame([], schema).schema)

    assert table("stream_predictions").count() == 3 and table("quarantine").count() == 1
    run_live(spark, folder, out)
    assert table("stream_predictions").count() == 3, "a restart adds nothing"

    message_files(spark, folder, ["great", "great"], 2)
    run_live(spark, folder, out)
    assert table("stream_predictions").count() == 5
    counts = totals("live_counts", "sentiment STRING, n BIGINT")
    assert rows(counts) == [("Negative", 1), ("Neutral", 1), ("Positive", 3)]
    trend = totals("live_trend", "window_start TIMESTAMP, sentiment STRING, n BIGINT")
    assert sum(r.n for r in trend.collect()) == 5


def test_quarantine_keeps_the_message_and_the_reason(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    values = ["not json", '{"text": "great", "timestamp": "soon"}', '{"text": "bad", "timestamp": "2024-01-01 10:00:00"}']
    spark.createDataFrame([(v,) for v in values], "value STRING").selectExpr("CAST(value AS BINARY) AS value").coalesce(1).write.parquet(f"{folder}/part=1")
    run_live(spark, folder, out)
    kept = stream_sinks.read_sink(spark, f"{out}/quarantine", spark.createDataFrame([], "value STRING, reason STRING").schema)
    assert rows(kept, "value", "reason") == [("not json", "no text"), (values[1], "no time")]
    assert stream_sinks.read_sink(spark, f"{out}/stream_predictions", spark.createDataFrame([], "text STRING").schema).count() == 2


@pytest.mark.parametrize(
    "name",
    ["stream_parse", "stream_score", "stream_append", "stream_sentiment_counts", "stream_trend_tumbling", "stream_trend_sliding", "stream_dedup"],
)
def test_streams_over_many_batches_keep_every_row(spark, small, name, shuffled_tables, monkeypatch):
    """The same rows from one file in one batch as from five shuffled files, one in each batch."""
    from wordtide.plans import queries

    once = rows(queries.QUERIES[name](spark, small))
    monkeypatch.setattr(queries, "stream_table", functools.partial(stream_table, files_per_batch=1))
    assert rows(queries.QUERIES[name](spark, shuffled_tables)) == once and once


@pytest.fixture(scope="module")
def shuffled_tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    for name in ("events", "documents"):
        tables.read_table(spark, "/root/testdata/sf0.001", name).repartition(5).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_stream_scores_equal_batch_scores(spark, small):
    documents = stream_table(spark, small, "documents").select("doc_id", "text")
    stream = scoring.score_messages(documents).select("doc_id", "score", "sentiment")
    streamed = stream_sinks.run_to_table(stream, fresh_path(spark, "parity")).drop("batch_id")
    batch = scoring.score_messages(tables.read_table(spark, small, "documents")).select("doc_id", "score", "sentiment")
    assert rows(streamed) == rows(batch)


def held(spark, path):
    """Rows by batch of a sink of numbers."""
    found = stream_sinks.read_sink(spark, path, spark.range(1).schema)
    return {r.batch_id: r["count"] for r in found.groupBy("batch_id").count().collect()}


def test_a_retried_batch_counts_once(spark, tmp_path):
    path = str(tmp_path)
    stream_sinks.write_batch(spark.range(5), 7, path)
    stream_sinks.write_batch(spark.range(3), 7, path)
    stream_sinks.write_batch(spark.range(2), 8, path)
    assert held(spark, path) == {7: 5, 8: 2}


def test_an_unfinished_batch_is_invisible(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    stream_sinks.write_batch(spark.range(5), 0, path)

    def fail(*args, **kwargs):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as patch:
        patch.setattr(manifest, "commit", fail)
        with pytest.raises(RuntimeError):
            stream_sinks.write_batch(spark.range(9), 1, path)
    assert len(list((tmp_path / "data").iterdir())) == 2
    assert held(spark, path) == {0: 5}
    stream_sinks.write_batch(spark.range(9), 1, path)
    assert held(spark, path) == {0: 5, 1: 9}


def test_many_batches_leave_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_sinks, "FOLD", 4)
    path, most = str(tmp_path), 0
    for batch in range(40):
        stream_sinks.write_batch(spark.range(batch % 3 + 1).coalesce(1), batch, path)
        state = manifest.latest(spark, path)[1]
        most = max(most, len(state["segments"]))
    assert held(spark, path) == {b: b % 3 + 1 for b in range(40)}
    # Three of each level at most: 40 batches are three levels of four.
    assert most <= 9 and len(list(tmp_path.glob("data/*/*.parquet"))) <= 9 + 4 * manifest.KEPT
    assert [s["bytes"] for s in state["segments"]] and all(s["bytes"] > 0 for s in state["segments"])


def test_full_segments_are_left_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_sinks, "FOLD", 2)
    monkeypatch.setattr(stream_sinks, "FULL_BYTES", 1)
    for batch in range(4):
        stream_sinks.write_batch(spark.range(3), batch, str(tmp_path))
    state = manifest.latest(spark, str(tmp_path))[1]
    assert [s["level"] for s in state["segments"]] == [stream_sinks.FULL] * 2
    assert held(spark, str(tmp_path)) == {b: 3 for b in range(4)}


def number_stream(spark, folder, parts, **options):
    for part, numbers in enumerate(parts):
        spark.createDataFrame([(n,) for n in numbers], "id BIGINT").coalesce(1).write.mode("overwrite").parquet(f"{folder}/part={part}")
    return stream_source(spark, "parquet", "id BIGINT", f"{folder}/*", maxFilesPerTrigger=1, **options)


def test_a_table_belongs_to_its_checkpoint(spark, tmp_path):
    stream, count = number_stream(spark, f"{tmp_path}/in", [[1], [1, 2]]), lambda df: df.groupBy("id").agg(F.count("*").alias("n"))
    for start in (lambda p, c: stream_sinks.start_sink(stream, p, c), lambda p, c: stream_sinks.start_merge(stream, count, p, c), lambda p, c: stream_sinks.start_unique(stream, "id", p, c)):
        path = fresh_path(spark, "owned")
        start(f"{path}/table", f"{path}/one").awaitTermination()
        start(f"{path}/table", f"{path}/one").awaitTermination()
        with pytest.raises(ValueError, match="another checkpoint"):
            start(f"{path}/table", f"{path}/two")


def test_unique_keys_over_all_batches_without_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_sinks, "FOLD", 3)
    parts = [[k, k + 1, k + 1, 0, k // 2] for k in range(0, 22, 2)] + [[None, 5], [None, 99]]
    stream, path = number_stream(spark, f"{tmp_path}/in", parts), str(tmp_path / "out")
    query = stream_sinks.start_unique(stream, "id", path, f"{path}-checkpoint")
    query.awaitTermination()
    got = stream_sinks.read_sink(spark, path, spark.createDataFrame([], "id BIGINT").schema)
    assert sorted((r.id for r in got.collect()), key=repr) == sorted({n for p in parts for n in p}, key=repr)
    assert len(query.recentProgress) >= len(parts) and all(not p["stateOperators"] for p in query.recentProgress)
    state = manifest.latest(spark, path)[1]
    assert len(state["keys"]) <= 6 and len(state["segments"]) <= 6


def test_totals_survive_a_retry(spark, tmp_path):
    counts, path = spark.createDataFrame([("a", 2)], "k STRING, n BIGINT"), str(tmp_path)
    for batch in (0, 0, 1, 1, 0):
        stream_sinks.merge_batch(counts, batch, path)
    assert rows(stream_sinks.read_totals(spark, path, counts.schema)) == [("a", 4)]


def test_a_stream_without_input_leaves_an_empty_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = stream_source(spark, "parquet", "value BINARY", str(tmp_path / "in"))
    assert stream_sinks.run_to_table(stream, str(tmp_path / "out")).count() == 0


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    events = spark.range(10).withColumn("ts", F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000))
    for part in (1, 2):
        events.coalesce(1).write.parquet(f"{tmp_path}/in/part={part}")
    stream = stream_source(spark, "parquet", "id BIGINT, ts TIMESTAMP", f"{tmp_path}/in/*", maxFilesPerTrigger=1)
    once = stream_sinks.run_to_table(scoring.drop_repeats(stream, "id", "ts", "1 day"), str(tmp_path / "out"))
    assert sorted(r.id for r in once.collect()) == list(range(10))


def test_staging_leaves_no_shuffle_files(spark):
    import time

    from wordtide.session import stage

    def held():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    before, setting = held(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    staged = stage(spark.range(1000).repartition(3, "id"), "kept")
    # Spark removes them in the background.
    until = time.monotonic() + 20
    while held() > before and time.monotonic() < until:
        time.sleep(0.2)
    assert held() <= before and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert staged.count() == 1000
