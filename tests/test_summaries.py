"""Checksums of content, mergeable sketches, and live top words with bounds."""

import functools
import random
from collections import Counter

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from wordtide.operators import wordstats
from wordtide.session import fresh_path
from wordtide.sources import manifest, sinks, tables
from wordtide.streaming import toplist
from wordtide.streaming.sources import stream_source, stream_table

BASE = [(1, "a", [1.5]), (2, None, None), (3, "c", []), (3, "c", [])]
SCHEMA = "k BIGINT, t STRING, v ARRAY<DOUBLE>"


def checksum(df):
    return df.agg(*sinks.content_checksum(df)).first()


def test_checksum_ignores_order_and_layout(spark):
    df = spark.createDataFrame(BASE, SCHEMA)
    assert checksum(df) == checksum(df.orderBy(F.desc("k")).repartition(3))
    assert checksum(df.where("false")) == checksum(df.limit(0))


@pytest.mark.parametrize(
    "changed",
    [
        [(1, "b", [1.5]), *BASE[1:]], [(1, "a", None), *BASE[1:]], BASE[:3], [*BASE, BASE[3]], [(1, None, [1.5]), (2, "a", None), *BASE[2:]],
        [BASE[0], BASE[0], *BASE[2:]], [(1, "a", [1.5]), (None, "2", None), *BASE[2:]], [(1, "a", [1.5]), (2, None, []), *BASE[2:]],
    ],
)
def test_checksum_finds_one_changed_row(spark, changed):
    assert checksum(spark.createDataFrame(BASE, SCHEMA)) != checksum(spark.createDataFrame(changed, SCHEMA))


def test_landing_is_verified_by_content(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(BASE, SCHEMA).withColumn("m", F.create_map(F.lit("x"), F.col("k")))
    assert rows(sinks.land_verified(spark, df, str(tmp_path), "one")) == [("one", 4, 4, True)]
    real = type(spark.read).parquet
    broken = lambda self, path: real(self, path).withColumn("t", F.when(F.col("k") == 1, "x").otherwise(F.col("t")))
    monkeypatch.setattr(type(spark.read), "parquet", broken)
    assert rows(sinks.land_verified(spark, df, str(tmp_path), "two")) == [("two", 4, 4, False)]


def test_merged_sketches_are_the_sketch_of_the_whole(spark):
    posts = tables.documents(spark, SMALL)
    parts = wordstats.word_sketches(posts.withColumn("part", F.pmod(F.hash("id"), F.lit(7))), "part")
    merged = wordstats.estimated_words(wordstats.merge_sketches(parts)).first()[0]
    whole = wordstats.estimated_words(wordstats.word_sketches(posts)).first()[0]
    exact = wordstats.unique_words(posts).first()[0]
    assert abs(merged - whole) <= 0.02 * exact and abs(merged - exact) <= 0.05 * exact


def test_stored_sketches_grow_over_time(spark, tmp_path):
    path = str(tmp_path / "sketches")
    for day, words in enumerate((["aaa bbb ccc"], ["bbb ddd"], [])):
        posts = spark.createDataFrame([(w, day) for w in words], "text STRING, day INT")
        wordstats.word_sketches(posts, "day").write.mode("append").parquet(path)
    stored = spark.read.schema("day INT, sketch BINARY").parquet(path)
    assert rows(wordstats.estimated_words(stored)) == [(0, 3), (1, 2)]
    assert wordstats.estimated_words(wordstats.merge_sketches(stored)).first()[0] == 4


def counts_of(spark, words):
    return spark.createDataFrame(list(Counter(words).items()), "word STRING, n BIGINT")


@pytest.mark.parametrize("size", [5, 12, 1000])
def test_bounds_hold_the_true_counts(spark, tmp_path, size):
    random.seed(size)
    path, seen = str(tmp_path), Counter()
    for batch in range(8):
        words = [f"w{min(int(random.expovariate(0.15)), 60)}" for _ in range(300)]
        seen.update(words)
        for _ in range(2):
            toplist.add_batch(counts_of(spark, words), batch, path, size)
    state = manifest.latest(spark, path)[1]
    top = toplist.read_top_words(spark, path, 4).collect()
    for r in top:
        assert r.least <= seen[r.word] <= r.most
    kept = toplist.read_segments(spark, path, state["segments"], spark.createDataFrame([], toplist.SCHEMA).schema).collect()
    assert len(kept) <= size and all(r.least <= seen[r.word] <= r.most for r in kept)
    assert all(n <= state["floor"] for w, n in seen.items() if w not in {r.word for r in kept})
    want = sorted(seen, key=lambda w: (-seen[w], w))[:4]
    assert all(r.word in want for r in top if r.sure)
    if size == 1000:
        assert [r.word for r in top] == want and all(r.sure for r in top) and state["floor"] == 0


def test_live_top_words_equal_the_batch_ones(spark, tmp_path):
    tables.read_table(spark, SMALL, "documents").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    stream = stream_table(spark, str(tmp_path), "documents", files_per_batch=1).select("text")
    counted = functools.partial(wordstats.word_count, rule="cleaned")
    live = toplist.run_to_top_words(stream, counted, fresh_path(spark, "top"), 20)
    batch = wordstats.top_words(wordstats.word_count(tables.documents(spark, SMALL), "cleaned"), 20)
    assert rows(live.where("sure"), "word", "least", "rank") == rows(batch, "word", "n", "rank")


def test_no_words_yet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = stream_source(spark, "parquet", "text STRING", str(tmp_path / "in"))
    assert toplist.run_to_top_words(stream, lambda df: wordstats.word_count(df, "cleaned"), str(tmp_path / "out"), 5).count() == 0
