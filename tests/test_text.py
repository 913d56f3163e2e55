"""Cleaning, tokenizing and stemming against hand-derived values; whole tables are compared by the queries' SQL."""

import re
import unicodedata

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordtide.fixed_values import STOPWORDS, SUFFIX_RULES
from wordtide.functions import text as T
from wordtide.operators.preprocess import with_stems
from wordtide.sources.tables import read_table

CLEANED = [
    (None, ""),
    ("", ""),
    ("see http://x.y/z now", "see now"),
    ("foo#bar loooooove !!!!", "foobar loove"),
    ("@josé hi", "hi"),
    ("LoOoOo 1111 x", "looooo x"),
    ("ＡＢＣ ﬁne", "abc fine"),
    ("RT @a_b: #one#two http", "rt onetwo http"),
    ("@́abc", "abc"),
    ("go www.site.org now", "go now"),
    ("##twice ＡＡＡＡ", "twice aa"),
    ("café x", "caf x"),
    ("1ª 2º ĳ ſ K", "a o ij s k"),
    ("http\x1cnext", "http next"),
]


def text_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")


@pytest.mark.parametrize("form", ["column", "frame"])
def test_clean_text_values(spark, form):
    df = text_frame(spark, [a for a, _ in CLEANED])
    if form == "column":
        out = df.select("i", T.clean_text(F.col("text")))
    else:
        out = T.with_clean_text(df).select("i", "cleaned_text")
    assert [r[1] for r in sorted(out.collect())] == [b for _, b in CLEANED]


COMPATIBLE = [("ﬁ ﬂ", "fi fl"), ("Ａｂ", "ab"), ("e\u0301a", "a"), ("ⅷ x", "viii x"), ("½ cup", "cup"), ("㎏ b", "kg b"), ("é", "")]


def test_compatible_characters_are_unfolded(spark):
    out = T.with_clean_text(text_frame(spark, [a for a, _ in COMPATIBLE])).select("i", "cleaned_text").collect()
    assert [r[1] for r in sorted(out)] == [b for _, b in COMPATIBLE]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from("aAbB #@_.1é́ﬁＡ\n  htpw:/"), max_size=30), min_size=30, max_size=30))
def test_clean_text_is_plain_words_and_stays_as_it_is(spark, texts):
    once = T.with_clean_text(text_frame(spark, texts)).select("i", F.col("cleaned_text").alias("text"))
    both = T.with_clean_text(once).select("text", "cleaned_text").collect()
    assert all(r.text == r.text.lower().strip() and set(r.text) <= set("abcdefghijklmnopqrstuvwxyz ") and "  " not in r.text for r in both)
    # What looks like a link only after cleaning is removed by the next cleaning.
    assert all(r.text == r.cleaned_text for r in both if "http" not in r.text and not any(c * 3 in r.text for c in "abhtpw"))


def test_inert_characters_never_need_normalization():
    """No inert character turns into an ASCII letter or combines with its neighbours."""
    inert = re.compile(f"[{T.INERT}]")
    for code in range(0x80, 0x10000):
        char = chr(code)
        if not inert.match(char):
            continue
        assert not re.search("[a-zA-Z]", unicodedata.normalize("NFKC", char)), hex(code)
        assert unicodedata.combining(char) == 0
        assert not re.search("[a-zA-Z]", unicodedata.normalize("NFKC", "́" + char))
        assert unicodedata.normalize("NFKC", "e" + char)[0] == "e"


def test_only_text_open_to_change_is_sent_to_python(spark):
    df = text_frame(spark, ["plain", "déjà vu — “ok” €", "ﬁne", "é"])
    sent = df.where(F.col("text").rlike(rf"[^\x00-\x7F](?<![{T.INERT}])"))
    assert rows(sent.select("i")) == [(2,), (3,)]


def test_light_cleaner(spark):
    texts = ["Hi @you #tag soooo http://a.b c", None, "www.site.org É x"]
    out = text_frame(spark, texts).select("i", T.clean_text_light(F.col("text")))
    assert rows(out) == [(0, "hi tag soooo c"), (1, ""), (2, "www site org x")]


def test_tokenize_keeps_order_and_repeats(spark):
    df = text_frame(spark, ["the cat saw it the cat ran", "", None])
    out = df.select("i", T.tokenize(F.col("text")))
    assert rows(out) == [(0, ["cat", "saw", "cat", "ran"]), (1, []), (2, [])]


def test_stems(spark):
    pairs = [
        ("ing", ""), ("est", ""), ("red", "r"), ("running", "runn"), ("national", "nate"),
        ("parties", "party"), ("happiness", "happi"), ("cat", "cat"), ("conditional", "condition"), ("creator", "create"),
    ]
    out = text_frame(spark, [a for a, _ in pairs]).select("i", T.stem_word(F.col("text")))
    assert [r[1] for r in sorted(out.collect())] == [b for _, b in pairs]


def test_empty_stems_leave_double_spaces(spark):
    df = text_frame(spark, ["big ing red"])
    assert df.select(T.join_tokens(T.stem(T.tokenize(F.col("text"))))).first()[0] == "big  r"


WORDS = {
    "letters": ["don", "caf", "été", "sayhithere", "http", "com", "https", "net"],
    "alpha": ["caf", "été"],
    "raw": ["don't", "caf", "été", 'say"hi"there', "http://x.com", "https://y.net", "x1y"],
    "mapreduce": ["don", "caf", "été", "say", "there", "com", "net"],
    "cleaned": ["don", "t", "caf", "t", "a", "say", "hi", "there", "x", "y"],
}


@pytest.mark.parametrize("rule", WORDS)
def test_word_rules(spark, rule):
    text = "Don't caf Été a say\"hi\"there http://x.com https://y.net x1y"
    got = text_frame(spark, [text]).select(T.WORD_RULES[rule](F.col("text"))).first()[0]
    assert got == WORDS[rule]
