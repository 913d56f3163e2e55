"""Ids beyond 2**53 next to NULLs, and columns that Python can't hold, through every operator that Python works in."""

import pytest
from conftest import rows

from wordtide.llm import decontamination, packing, simhash, token_files, toxicity, warc

LARGE = [2**53 + 1, None, 2**63 - 1, 2**53 + 3, -(2**62) - 1]


@pytest.fixture(scope="module")
def docs(spark):
    made = [(i, f"document {k} has some words of its own, {'and more ' * k}") for k, i in enumerate(LARGE)]
    frame = spark.createDataFrame(made, "doc_id BIGINT, text STRING").coalesce(1)
    return frame.selectExpr(
        "*", "CASE WHEN doc_id IS NOT NULL THEN 9007199254740993 END AS n", "TIMESTAMP'1500-01-01 00:00:00' AS old",
        "make_interval(1, 2, 3) AS calendar", "INTERVAL '1-2' YEAR TO MONTH AS months", "CAST(NULL AS VOID) AS nothing", "map('a', doc_id) AS pairs",
    )


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "has some words of its own and more and more and more"), (2, None)], "item_id BIGINT, text STRING")


def ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=repr)


WANT = sorted(LARGE, key=repr)


def test_ids_through_the_operators(docs, benchmark):
    assert ids(packing.pack_documents(docs)) == WANT
    assert ids(token_files.token_files(docs)) == WANT
    assert ids(decontamination.contamination(docs, benchmark)) == WANT
    found = simhash.document_groups(docs)
    assert ids(found) == WANT
    by_group = {}
    for r in found.collect():
        by_group.setdefault(r.component, []).append(r)
    for group in by_group.values():
        assert {r.component_id for r in group} == {min((r.doc_id for r in group if r.doc_id is not None), default=None)}


def test_ids_of_scores(spark, docs):
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(LARGE)], "doc_id BIGINT, toxic INT")
    assert ids(toxicity.score_documents(docs, toxicity.fit_model(docs, labels))) == WANT


def test_ids_of_pages(spark):
    pages = spark.createDataFrame([(i, "u", "same" if k % 2 == 0 else f"own {k}") for k, i in enumerate(LARGE)], "page_id BIGINT, url STRING, html STRING").coalesce(1)
    got = warc.warc_round_trip(pages)
    assert ids(got, "page_id") == WANT
    assert {r.refers_to for r in got.collect()} == {None, -(2**62) - 1}


def test_stages_pass_on_columns_of_any_type(spark, docs, benchmark):
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(LARGE)], "doc_id BIGINT, toxic INT")
    whole = docs.selectExpr("doc_id", "text", "n", "CAST(old AS STRING) old", "CAST(calendar AS STRING) c", "CAST(months AS STRING) m", "pairs['a'] p")
    seen = lambda df: rows(df.selectExpr("doc_id", "text", "n", "CAST(old AS STRING) old", "CAST(calendar AS STRING) c", "CAST(months AS STRING) m", "pairs['a'] p"))
    network = toxicity.fit_model(docs, labels).network
    kept = toxicity.drop_toxic(docs, toxicity.ToxicityModel(network, {None: 2.0}))
    assert kept.schema == docs.schema and seen(kept) == rows(whole)
    assert toxicity.drop_toxic(docs, toxicity.ToxicityModel(network, {None: 0.0})).count() == 0
    clean = decontamination.remove_contaminated(docs, benchmark)
    assert clean.schema == docs.schema
    hit = {r.doc_id for r in decontamination.contamination(docs, benchmark).collect() if r.contaminated}
    assert hit and seen(clean) == [r for r in rows(whole) if r[0] not in hit]


def test_different_texts_of_one_id_both_stay(spark):
    far = "quite another text about other things, long enough to be far from the first one in all its words"
    near = "the very same long text with many words that is found here more than once for sure, again and again"
    texts = [(5, near), (5, far), (5, far), (9, near), (None, far), (None, far), (3, near + "."), (11, "a third text, which nothing else in here is like at all, in none of its words")]
    kept = simhash.one_of_each(spark.createDataFrame(texts, "doc_id BIGINT, text STRING").selectExpr("*", "1 AS digest", "2 AS component_id"))
    assert kept.columns == ["doc_id", "text", "digest", "component_id"]
    got = rows(kept, "doc_id", "text")
    assert (5, far) in got and got.count((5, far)) == 1 and got.count((None, far)) == 2
    assert sum(t.startswith("the very") for _, t in got) in (1, 2) and any(i == 11 for i, _ in got)
