"""Declared schemas. Readers never infer types."""

from __future__ import annotations

# Headerless CSV of posts.
POSTS_CSV = "polarity INT, id STRING, date STRING, query STRING, user STRING, text STRING"

# Output of the preprocessing plan; ``label`` is the partition column.
PREPROCESSED = (
    "id STRING, date STRING, polarity INT, text STRING, cleaned_text STRING, "
    "processed_text STRING, stemmed_tokens ARRAY<STRING>, label INT"
)

# JSON value of a stream message.
MESSAGE = "text STRING, user STRING, timestamp STRING"

# JSON held by the ``props`` column of ``events``.
EVENT_PROPS = "k BIGINT"

MODEL_METRICS = (
    "model_name STRING, position INT, accuracy DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE, "
    "auc DOUBLE, train_time_sec DOUBLE"
)

RUN_RECORD = (
    "run_id STRING, model_name STRING, metrics MAP<STRING, DOUBLE>, params MAP<STRING, STRING>, "
    "train_time_sec DOUBLE, timestamp TIMESTAMP"
)

LEXICON = "word STRING, weight INT"

# Parquet tables that stand in for posts, sources and streams.
TABLES = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    ),
}
