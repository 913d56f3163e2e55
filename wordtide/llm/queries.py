"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.llm.collocations import collocations
from wordtide.llm.common import bound_batches, table
from wordtide.llm.decontamination import contamination
from wordtide.llm.line_dedup import dedup_lines
from wordtide.llm.packing import pack_documents
from wordtide.llm.paragraph_sketch import compare_with_edits
from wordtide.llm.secret_scan import scan
from wordtide.llm.simhash import near_duplicates
from wordtide.llm.surrogates import entity_report
from wordtide.llm.token_counts import token_counts
from wordtide.llm.token_files import token_files
from wordtide.llm.toxicity import fit_model, score_documents
from wordtide.llm.warc import warc_round_trip
from wordtide.llm.whitening import whiten_embeddings

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4_SQL = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM item WHERE len(w) > 0)
), size AS (
  SELECT DISTINCT n FROM item_window
), doc_window AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, size WHERE len(w) >= n)
), hit AS (
  SELECT doc_id, item_id, n, p FROM doc_window JOIN item_window USING (n, k)
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM hit)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM hit GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Base 32 of a SHA-1: forty bits, ten hex digits, at a time give eight letters.
OP7_SQL = """
WITH page AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages
), digest AS (
  SELECT page_id, n, h, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS BIGINT), 1)), '') AS payload_digest
  FROM page
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM digest)
"""

OP11_SQL = rf"""
WITH piece AS (
  SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), gram AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM piece, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
), counted AS (
  SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY lang, k, phrase
), candidate AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND f >= 30
), cut AS (
  SELECT lang, phrase, a, j, array_to_string(w[1 : j], ' ') AS head, array_to_string(w[j + 1 : k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidate)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.j, h.f AS l, t.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (CAST(h.f AS HUGEINT) + t.f) AS BIGINT) AS score
  FROM cut c JOIN counted h ON h.lang = c.lang AND h.phrase = c.head JOIN counted t ON t.lang = c.lang AND t.phrase = c.tail
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inner_phrase AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidate))
  GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b LEFT JOIN inner_phrase i USING (lang, phrase)
  WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a
), size AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN size USING (lang) WHERE rank <= 2000
"""

OP12_SQL = rf"""
WITH line AS (
  SELECT doc_id, row, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM (
    SELECT doc_id, row, unnest(lines) AS line, unnest(range(len(lines))) AS pos
    FROM (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
  )
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM line WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT l.*, keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone FROM line l LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row, doc_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = lambda spark, sf_dir: function(bound_batches(spark), sf_dir)
        if sql:
            ORACLE[name] = sql
        return function

    return add


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of byte_bpe_50k over all documents, through a cache that starts empty."""
    return token_counts(table(spark, sf_dir, "documents"))


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 2,048 ids."""
    return pack_documents(table(spark, sf_dir, "documents"))


@query("op9_token_planes")
def op9_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as bit planes and read back."""
    return token_files(table(spark, sf_dir, "documents"))


@query("op6_simhash_bk_trees")
def op6_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_suffix_array_decontamination", OP4_SQL)
def op4_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all benchmark items in every document."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_warc_normaliser", OP7_SQL)
def op7_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, written as whole streams, rewritten by record and read back."""
    return warc_round_trip(table(spark, sf_dir, "pages"))


@query("op3_cnn_toxicity")
def op3_cnn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a network fitted to the labels of the others."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit_model(docs, table(spark, sf_dir, "labels")))


@query("op1_secret_forest")
def op1_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of all documents with the forest's verdict."""
    return scan(table(spark, sf_dir, "documents"))


@query("op8_pii_surrogates")
def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced."""
    return entity_report(table(spark, sf_dir, "documents"))


@query("op10_paragraph_sketches")
def op10_paragraph_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all documents and their edited texts, and their likeness."""
    return compare_with_edits(table(spark, sf_dir, "documents"))


@query("op11_collocations", OP11_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 phrases over all documents."""
    return collocations(table(spark, sf_dir, "documents"))


@query("op12_line_dedup", OP12_SQL)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that at least five of them share."""
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op13_feast_whitening")
def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all embeddings."""
    return whiten_embeddings(table(spark, sf_dir, "embeddings"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline from raw documents to packed sequences."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
