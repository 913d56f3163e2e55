"""Rows that are hard on every operator, as fixtures that the tests import."""

import pytest

# Every column that the operators name inside, as extra columns of their input.
CLASHING = {
    "content": "s", "digest": "s", "fp": 1, "rep": 2, "bucket": 3, "score": 0.5, "threshold": 0.1, "length": 7, "part": 8, "number": 9,
    "value": "v", "range": 1, "guest": True, "next_text": "n", "component": 4, "label": 1, "refers_to": 5, "_digest": "d", "_secret": "x",
    "size": 3, "path": "p", "first": 1, "n": 2, "ids": "i",
}

LONG = "word " * 40_000 + "end."
TEXTS = [
    (1, "One line here. Another sentence follows!\nAnd a last line, with 12 words in it."),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, "One line here. Another sentence follows!\nAnd a last line, with 12 words in it."),
    (5, "One line here. Another sentence follows!\nAnd a last line, with 12 words in it."),
    (None, "no id here, but a text of some words"),
    (7, "  spaces   and\ttabs \n\n <|endoftext|> ünïcödé ÀÉ 漢字 \U0001f600 x"),
    (8, "a"),
    (9, "ALL CAPS AND one more"),
]


@pytest.fixture
def hard_docs(spark):
    """Missing, empty, long, repeated and odd rows, with columns whose names operators use inside."""
    rows = [(i, t, None if k % 4 == 1 else "en", None if k % 3 == 1 else f"src{k}", None if t is None else len(t), *CLASHING.values()) for k, (i, t) in enumerate(TEXTS)]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
        f"`{k}` {'string' if isinstance(v, str) else 'boolean' if isinstance(v, bool) else 'double' if isinstance(v, float) else 'bigint'}" for k, v in CLASHING.items()
    )
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture
def no_docs(hard_docs):
    return hard_docs.where("false")
