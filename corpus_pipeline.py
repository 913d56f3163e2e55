"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

1. toxicity: documents that the classifier rejects go; it learns from the labelled documents, with a threshold for
   each language.
2. near-duplicates: one document of each group of similar texts stays, the one with the smallest id. Similar are texts
   whose five-word shingles agree to 0.8 and more; fingerprints find them, the whole sets of shingles confirm them.
3. decontamination: documents that hold ten consecutive words of a benchmark item go.
4. secrets: strings that the forest judges secret are masked; their documents stay.
5. packing: the token ids of what is left, in sequences of at most 2,048, with few gaps.

Stages 1 to 4 return the columns they were given. A NULL text counts as empty; an empty table stays empty; repeated
rows are copies for stage 2; rows without an id are never dropped as copies. Columns that are not read go through
unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wordtide.llm.common import bound_batches, fresh_path, table
from wordtide.llm.decontamination import remove_contaminated
from wordtide.llm.near_copies import one_of_near_copies
from wordtide.llm.packing import pack_documents
from wordtide.llm.secret_scan import mask_secrets
from wordtide.llm.toxicity import drop_toxic, fit_model

# Words that a worker remembers in packing, fewer than elsewhere: workers hold what earlier stages left behind as well.
REMEMBERED = 200_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(bound_batches(spark), sf_dir, "labels")
    return drop_toxic(docs, fit_model(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return one_of_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, table(bound_batches(spark), sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its ids (little-endian 32-bit), sequence and place in it."""
    bound_batches(spark)
    return pack_documents(docs, keep_ids=True, remembered=REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

# A fitted network, fingerprints and token ids have no form in SQL. Near-duplicates, decontamination and packing are
# tested against brute force, toxicity by held-out documents, secrets by planted ones.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's table stays in the shared folder."""
    base = fresh_path(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{base}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
