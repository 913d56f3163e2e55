"""Lines that many documents share, kept in one of them only.

Every text is exploded into its lines, a line's key is hashed, the distinct documents of each hash are counted, and the
lines over the threshold are dropped and the rest put together again by position.

Only hashes, ids and positions are shuffled by line. What is left of a text is made inside its row, so a text moves at
most once, to meet the positions that it loses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm.common import let, stage, whole

MIN_CHARS, MIN_DOCS = 40, 5
BLANK = " \t\n\u000b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case and all other letters as they are."""
    bare = F.btrim(line, F.lit(BLANK))
    # lower() changes other letters as well, but is much faster; texts of single bytes have no others.
    return let(bare, lambda k: F.when(F.octet_length(k) == F.length(k), F.lower(k)).otherwise(F.translate(k, UPPER, LOWER)))


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def digest(value: Column, *names: str) -> list[Column]:
    """Two hashes with different seeds, 128 bits together."""
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit("second"), value).alias(names[1])]


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key has ``min_chars`` code points: doc, the text's digest, position and the key's digest."""
    text = whole()
    lines = docs.select(F.col("doc_id").alias("doc"), *digest(text, "t1", "t2"), F.posexplode_outer(split_lines(text)).alias("pos", "line"))
    enough = lines.where(F.length(F.btrim("line", F.lit(BLANK))) >= min_chars)
    return enough.select("doc", "t1", "t2", "pos", line_key(F.col("line")).alias("key")).select("doc", "t1", "t2", "pos", *digest(F.col("key"), "h1", "h2"))


def repeated_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """Digests of keys in at least ``min_docs`` documents, with the largest document that holds each.

    The first shuffle goes by key and document, so a key that every document holds is spread over all tasks.
    """
    found = lines.select("h1", "h2", "doc").distinct().groupBy("h1", "h2").agg(F.count("doc").alias("n"), F.max("doc").alias("keeper"))
    return found.where(F.col("n") >= min_docs).select("h1", "h2", "keeper")


def dropped_positions(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """The positions that each text loses: doc, t1, t2 and ``lost``, an array of at most as many as the text has lines."""
    # Written out, so that the join has no aggregate on either side and Spark can split a key with very many lines.
    keys = stage(repeated_keys(long_lines(docs, min_chars), min_docs), "repeated-lines")
    hits = long_lines(docs, min_chars).join(keys, ["h1", "h2"])
    others = hits.where(F.col("doc").isNull() | (F.col("doc") != F.col("keeper")))
    return stage(others.groupBy("doc", "t1", "t2").agg(F.collect_set("pos").alias("lost")), "dropped-lines")


def without(lines: Column, lost: Column) -> Column:
    """The lines at positions that are not in ``lost``, in their order."""
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    return F.array_join(F.transform(F.array_except(every, lost), lambda i: F.get(lines, i)), "\n")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped and text, one row per row of ``docs``.

    A line goes if its key (blanks stripped at both ends, A-Z in lower case) has at least ``min_chars`` code points and
    is found in at least ``min_docs`` documents, except in the document with the largest id that holds it, which keeps
    all its lines of that key. The other lines stay as they are, joined by line feeds.

    A NULL or empty text is one empty line. Rows with one doc_id are one document, whatever their texts. A row without
    doc_id is no document that counts, and loses the lines that others lose. Other columns are not read; an empty table
    gives no rows.
    """
    gone = dropped_positions(docs, min_chars, min_docs)
    texts = docs.select("doc_id", whole().alias("text")).select("doc_id", "text", *digest(F.col("text"), "d1", "d2"))
    same = texts["doc_id"].eqNullSafe(gone["doc"]) & (texts["d1"] == gone["t1"]) & (texts["d2"] == gone["t2"])
    both = texts.join(gone, same, "left")
    kept = F.when(F.col("lost").isNull(), F.col("text")).otherwise(let(split_lines(F.col("text")), lambda lines: without(lines, F.col("lost"))))
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    n_dropped = F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost"))
    return both.select("doc_id", n_lines.cast("bigint").alias("n_lines"), n_dropped.cast("bigint").alias("n_dropped"), kept.alias("text"))
