"""In-row array work that replaces a shuffle per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_words(df: DataFrame, words: Column, *keep: str | Column, out: str = "word", pos: bool = False) -> DataFrame:
    """One row per element of an array expression, with its position if asked; empty arrays give no row.

    A plain ``explode`` makes the optimizer copy the expression into a filter on the array size, next to the scan,
    so the whole text would be processed twice. The outer form is left as it is, and its NULL row is dropped.
    """
    rows = F.posexplode_outer(words).alias("pos", out) if pos else F.explode_outer(words).alias(out)
    return df.select(*keep, rows).where(F.col(out).isNotNull())


def bigrams(tokens: Column) -> Column:
    """Adjacent token pairs, joined by a space. Fewer than two tokens give an empty array.

    ``tokens`` should be a plain column: it is read several times.
    """
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    joined = F.zip_with(tokens, F.slice(tokens, 2, pairs), lambda a, b: F.concat_ws(" ", a, b))
    return F.slice(joined, 1, pairs)


def term_counts(docs: DataFrame, tokens: str, *keep: str) -> DataFrame:
    """One row per document and distinct term: the ``keep`` columns, ``term``, ``tf``.

    A document is one row, so its terms are counted inside the row: sort the tokens, find where
    each run begins, and take the distance to the next run. No shuffle takes place.
    """
    ordered = docs.select(*keep, F.sort_array(tokens).alias("_sorted"))
    size = F.size("_sorted")
    starts = F.filter(
        F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)),
    )
    runs = ordered.withColumn("_starts", starts)
    counted = F.zip_with(
        "_starts",
        F.slice("_starts", 2, F.size("_starts")),
        lambda a, b: F.struct(
            F.get("_sorted", a).alias("term"),
            (F.coalesce(b, F.size("_sorted")) - a).cast("bigint").alias("tf"),
        ),
    )
    return runs.select(*keep, F.inline_outer(counted)).where(F.col("term").isNotNull())
