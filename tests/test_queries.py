"""Every registered query against its SQL, and plan properties."""

import pytest
from compare import connect, differences, spark_rows, sql_rows
from conftest import SMALL, plan

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


# The queries of the training-data operators have tests of their own.
WITHOUT_SQL = [name for name in QUERIES if name not in ORACLE and not name.startswith("op") and name != "pipeline"]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert differences(spark_rows(QUERIES[name](spark, SMALL)), sql_rows(con, ORACLE[name])) is None


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["label", "word", "n", "rank"]


@pytest.mark.parametrize("name", ["label_counts", "word_count_raw", "lexicon_score", "lexicon_score_join", "top_words_by_label", "kpi_summary", "stem"])
def test_no_row_at_a_time_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_columns_are_pruned(spark):
    text = plan(QUERIES["kpi_summary"](spark, SMALL))
    assert "text" not in text.split("ReadSchema")[1].split("\n")[0]


def test_text_is_cleaned_once(spark):
    for name in ("tokenize", "stem", "top_words_by_label"):
        assert plan(QUERIES[name](spark, SMALL)).count("ArrowEvalPython") == 1, name
