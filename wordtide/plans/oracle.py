"""Independent SQL for the registered queries, written for DuckDB, which runs it on the same tables.

The text rules are stated again in the terms of another regular expression engine: it has no
back-references and no look-around, so runs are squeezed letter by letter and words are split
instead of matched.
"""

from __future__ import annotations

from string import ascii_letters

from wordtide.fixed_values import (
    BIGRAM_MIN_DOCS,
    BIGRAM_VOCABULARY,
    CONFIDENCE_WORDS,
    CORPUS_LEXICON,
    CV_FOLDS,
    EVENT_SENTIMENT,
    KEYWORD_CONFIDENCE,
    KEYWORDS,
    MESSAGE_TEXTS,
    MIN_DOC_FREQ,
    SAMPLE_POSTS,
    STOPWORDS,
    STREAM_LEXICON,
    SUFFIX_RULES,
    TOKEN_LEXICON,
    TRAIN_PERCENT,
    WORD2VEC_MIN_COUNT,
    WORD2VEC_SIZE,
)


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def sql_list(values) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


SPACE = (
    r"\t\n\v\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

DOCS = "docs AS (SELECT CAST(doc_id AS VARCHAR) AS id, text, lang, source FROM documents)"

POSTS = """posts AS (
    SELECT CAST(d.doc_id AS VARCHAR) AS id, d.text, d.source,
           CASE l.toxic WHEN 0 THEN 4 WHEN 1 THEN 0 END AS polarity
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

VALID = POSTS + """,
valid AS (
    SELECT *, CASE WHEN polarity = 4 THEN 1 ELSE 0 END AS label FROM posts
    WHERE text IS NOT NULL AND polarity IN (0, 4) AND length(text) > 0)"""


# Text


def cleaned(text: str) -> str:
    sql = f"coalesce({text}, '')"
    sql = rf"regexp_replace({sql}, 'http[^{SPACE}]+|www\.[^{SPACE}]+', '', 'g')"
    sql = rf"regexp_replace({sql}, '@[\p{{L}}\p{{N}}_]+', '', 'g')"
    sql = rf"regexp_replace({sql}, '#([\p{{L}}\p{{N}}_]+)', '\1', 'g')"
    for letter in ascii_letters:
        sql = f"regexp_replace({sql}, '{letter}{{3,}}', '{letter * 2}', 'g')"
    sql = rf"lower(regexp_replace(nfc_normalize({sql}), '[^a-zA-Z\s]', ' ', 'g'))"
    return rf"trim(regexp_replace({sql}, '\s+', ' ', 'g'))"


def cleaned_light(text: str) -> str:
    sql = rf"regexp_replace(coalesce({text}, ''), 'http[^{SPACE}]+', '', 'g')"
    sql = rf"regexp_replace({sql}, '@[\p{{L}}\p{{N}}_]+', '', 'g')"
    return rf"trim(regexp_replace(lower(regexp_replace({sql}, '[^a-zA-Z\s]', ' ', 'g')), '\s+', ' ', 'g'))"


def token_list(clean: str) -> str:
    return f"list_filter(string_split({clean}, ' '), lambda x: length(x) > 2 AND x NOT IN {in_list(STOPWORDS)})"


def stemmed(word: str) -> str:
    rules = " ".join(
        f"WHEN ends_with({word}, '{suffix}') THEN left({word}, length({word}) - {len(suffix)}) || '{end}'"
        for suffix, end in SUFFIX_RULES
    )
    return f"CASE {rules} ELSE {word} END"


def positions(rows: str, key: str, array: str, out: str, start: int = 0) -> str:
    """Rows of key, pos, element of an array column."""
    return (
        f"SELECT {key}, CAST(generate_subscripts({array}, 1) - 1 + {start} AS INTEGER) AS pos, "
        f"unnest({array}) AS {out} FROM {rows}"
    )


CLEAN = f"{DOCS}, clean AS (SELECT id, {cleaned('text')} AS cleaned_text FROM docs)"
TOKENS = f"{CLEAN}, tokens AS (SELECT id, {token_list('cleaned_text')} AS tokens FROM clean)"
STEMS = f"{TOKENS}, stems AS (SELECT id, list_transform(tokens, lambda x: {stemmed('x')}) AS stems FROM tokens)"


# Word statistics


def letter_words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '[^\p{{L}}]+'), lambda x: length(x) > 2)"


WORDS = {
    "letters": letter_words("lower(replace(text, '\"', ''))"),
    "alpha": (
        rf"list_transform(list_filter(regexp_split_to_array(text, '[{SPACE}]+'), "
        r"lambda x: length(x) > 2 AND regexp_full_match(x, '\p{L}+')), lambda x: lower(x))"
    ),
    "raw": (
        rf"list_transform(list_filter(regexp_split_to_array(text, '[{SPACE}]+'), "
        r"lambda x: length(x) > 2), lambda x: lower(x))"
    ),
    "mapreduce": letter_words("replace(replace(lower(text), 'http://', ''), 'https://', '')"),
    "cleaned": f"list_filter(string_split({cleaned_light('text')}, ' '), lambda x: x <> '')",
}


def counts(rule: str, rows: str = "docs") -> str:
    return (
        f"words AS (SELECT unnest({WORDS[rule]}) AS word FROM {rows}), "
        "counts AS (SELECT word, count(*) AS n FROM words GROUP BY word)"
    )


# Scores


def weight_case(word: str, lexicon: dict[str, int]) -> str:
    rules = " ".join(f"WHEN {quoted(w)} THEN {n}" for w, n in lexicon.items())
    return f"CASE {word} {rules} ELSE 0 END"


def token_score(text: str, lexicon: dict[str, int]) -> str:
    words = rf"regexp_split_to_array(lower({text}), '[{SPACE}]+')"
    return f"CAST(coalesce(list_sum(list_transform({words}, lambda x: {weight_case('x', lexicon)})), 0) AS BIGINT)"


def substring_score(text: str, lexicon: dict[str, int]) -> str:
    return " + ".join(f"CASE WHEN contains(lower({text}), {quoted(w)}) THEN {n} ELSE 0 END" for w, n in lexicon.items())


def sign_class(score: str) -> str:
    return f"CASE WHEN {score} > 0 THEN 'Positive' WHEN {score} < 0 THEN 'Negative' WHEN {score} = 0 THEN 'Neutral' END"


def contained(text: str, words) -> str:
    return " + ".join(f"CASE WHEN contains(lower({text}), {quoted(w)}) THEN 1 ELSE 0 END" for w in words)


SCORED = (
    f"{DOCS}, scores AS (SELECT id, {token_score('text', CORPUS_LEXICON)} AS score FROM docs), "
    f"scored AS (SELECT id, score, {sign_class('score')} AS sentiment FROM scores)"
)

MESSAGES = f"""messages AS (
    SELECT event_id, ({sql_list(MESSAGE_TEXTS)})[CAST(event_id % {len(MESSAGE_TEXTS)} AS BIGINT) + 1] AS text,
           'user_' || CAST(user_id AS VARCHAR) AS "user", strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp"
    FROM events)"""

EVENTS = (
    "scored AS (SELECT event_id, ts, event_type, CASE event_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_SENTIMENT.items())
    + " ELSE 'Neutral' END AS sentiment FROM events)"
)


# Metrics

METRIC_ROWS = """
confusion AS (SELECT model_name, position, label, prediction, count(*) AS n FROM predictions GROUP BY ALL),
classes AS (SELECT DISTINCT model_name, position, label AS class FROM confusion),
sides AS (
    SELECT k.model_name, k.position, k.class,
           sum(n) FILTER (label = class) AS actual,
           coalesce(sum(n) FILTER (prediction = class), 0) AS predicted,
           coalesce(sum(n) FILTER (label = class AND prediction = class), 0) AS hits
    FROM classes k JOIN confusion c ON k.model_name = c.model_name GROUP BY ALL),
rates AS (
    SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS p, hits / actual AS r FROM sides),
metrics AS (
    SELECT model_name, position,
           round(sum(hits) / sum(actual), 4) AS accuracy,
           round(sum(p * actual) / sum(actual), 4) AS precision,
           round(sum(r * actual) / sum(actual), 4) AS recall,
           round(sum(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * actual) / sum(actual), 4) AS f1
    FROM rates GROUP BY model_name, position)"""

LEXICON_PREDICTIONS = (
    f"{VALID}, lex AS (SELECT id, label, {token_score('text', CORPUS_LEXICON)} AS score FROM valid)"
)

HEURISTICS = f"""{VALID}, predictions AS (
    SELECT 'Token Lexicon' AS model_name, 0 AS position, label,
           CASE WHEN {token_score('text', CORPUS_LEXICON)} < 0 THEN 0 ELSE 1 END AS prediction FROM valid
    UNION ALL
    SELECT 'Substring Lexicon', 1, label,
           CASE WHEN {substring_score('text', CORPUS_LEXICON)} < 0 THEN 0 ELSE 1 END FROM valid
    UNION ALL
    SELECT 'Keyword Rule', 2, label, CASE WHEN {contained('text', KEYWORDS)} > 0 THEN 1 ELSE 0 END FROM valid),
{METRIC_ROWS}"""

LONG_METRICS = " UNION ALL ".join(
    f"SELECT model_name, '{m}' AS metric, {m} AS value FROM metrics" for m in ("accuracy", "precision", "recall", "f1")
)


def auc(rows: str) -> str:
    """Mann-Whitney from average ranks."""
    return f"""
    ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM {rows}),
    sums AS (SELECT sum(r) FILTER (label = 1) AS rs, count(*) FILTER (label = 1) AS p,
                    count(*) FILTER (label <> 1) AS q FROM ranked)
    SELECT round((CAST(rs AS DOUBLE) - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * q), 6) AS auc FROM sums"""


def bucket(key: str, buckets: int, salt: str = "") -> str:
    return f"CAST(('0x' || substr(md5('{salt}' || {key}), 1, 8)) AS BIGINT) % {buckets}"


PAIR_LIST = (
    "list_transform(range(1, len(stems)), lambda i: stems[CAST(i AS BIGINT)] || ' ' || stems[CAST(i + 1 AS BIGINT)])"
)


def with_ctes(ctes: str, query: str) -> str:
    return f"WITH {ctes} {query}"


SPLIT = f"CASE WHEN {bucket('id', 100)} < {TRAIN_PERCENT} THEN 'train' ELSE 'test' END"

MODEL_NAMES = ["Random Forest", "Linear SVM", "MLP", "Logistic Regression", "Naive Bayes", "Gradient-Boosted Trees"]

VALID_STEMS = f"""{VALID},
clean AS (SELECT id, label, {cleaned('text')} AS cleaned_text FROM valid),
tokens AS (SELECT id, label, {token_list('cleaned_text')} AS stems FROM clean),
valid_stems AS (SELECT id, label, stems FROM tokens)"""

ORACLE: dict[str, str] = {
    "valid_posts": with_ctes(VALID, "SELECT id, polarity FROM valid"),
    "binary_label": with_ctes(
        VALID, "SELECT id, polarity, label, CAST(polarity = 4 AS DOUBLE) AS label_double FROM valid"
    ),
    "label_counts": with_ctes(VALID, "SELECT label, count(*) AS n FROM valid GROUP BY label"),
    "partition_invariance": with_ctes(
        VALID,
        "SELECT layout, label, count(*) AS n FROM valid, (VALUES ('as_read'), ('by_cores'), ('many')) t(layout) GROUP BY ALL",
    ),
    "clean_text": with_ctes(CLEAN, "SELECT id, cleaned_text FROM clean"),
    "clean_text_pages": f"SELECT page_id, {cleaned('html')} AS cleaned_text FROM pages",
    "clean_text_light": with_ctes(DOCS, f"SELECT id, {cleaned_light('text')} AS cleaned_text FROM docs"),
    "tokenize": with_ctes(TOKENS, positions("tokens", "id", "tokens", "token")),
    "tokenize_plain": with_ctes(
        f"{DOCS}, plain AS (SELECT id, string_split({cleaned_light('text')}, ' ') AS words FROM docs)",
        positions("plain", "id", "words", "token"),
    ),
    "stopword_anti_join": with_ctes(
        f"{CLEAN}, parts AS (SELECT id, string_split(cleaned_text, ' ') AS words FROM clean), "
        f"words AS ({positions('parts', 'id', 'words', 'token')})",
        f"SELECT * FROM words WHERE length(token) > 2 AND token NOT IN {in_list(STOPWORDS)}",
    ),
    "stem": with_ctes(STEMS, positions("stems", "id", "stems", "stem")),
    "processed_text": with_ctes(STEMS, "SELECT id, array_to_string(stems, ' ') AS processed_text FROM stems"),
    **{
        f"word_count_{name}": with_ctes(f"{DOCS}, {counts(rule)}", "SELECT word, n FROM counts")
        for name, rule in [
            ("letters", "letters"),
            ("alpha", "alpha"),
            ("raw", "raw"),
            ("mapreduce", "mapreduce"),
            ("sql", "cleaned"),
        ]
    },
    "top_words": with_ctes(
        f"{DOCS}, {counts('cleaned')}",
        "SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS rank FROM counts QUALIFY rank <= 20",
    ),
    "top_words_by_label": with_ctes(
        f"{VALID}, clean AS (SELECT label, {cleaned('text')} AS c FROM valid), "
        f"words AS (SELECT label, unnest({token_list('c')}) AS word FROM clean), "
        "counts AS (SELECT label, word, count(*) AS n FROM words GROUP BY ALL)",
        "SELECT label, word, n, CAST(row_number() OVER (PARTITION BY label ORDER BY n DESC, word) AS INTEGER) AS rank "
        "FROM counts QUALIFY rank <= 20",
    ),
    "corpus_stats": with_ctes(
        f"{POSTS}, {counts('letters', 'posts')}",
        "SELECT r.*, w.*, round(w.total_words / r.records, 6) AS avg_words FROM "
        "(SELECT count(*) AS records, count(*) FILTER (polarity = 4) AS positive, "
        "count(*) FILTER (polarity = 0) AS negative FROM posts) r, "
        "(SELECT CAST(sum(n) AS BIGINT) AS total_words, count(*) AS unique_words FROM counts) w",
    ),
    "unique_words": with_ctes(f"{DOCS}, {counts('letters')}", "SELECT count(*) AS unique_words FROM counts"),
    "lexicon_score": with_ctes(SCORED, "SELECT id, score, sentiment FROM scored"),
    "lexicon_score_join": with_ctes(SCORED, "SELECT id, score, sentiment FROM scored"),
    "lexicon_score_salted": with_ctes(SCORED, "SELECT id, score, sentiment FROM scored"),
    "lexicon_score_samples": with_ctes(
        f"""samples AS (
            SELECT CAST(event_id AS VARCHAR) AS id,
                   ({sql_list((*SAMPLE_POSTS, *MESSAGE_TEXTS))})[CAST(event_id % {len(SAMPLE_POSTS) + len(MESSAGE_TEXTS)} AS BIGINT) + 1] AS text
            FROM events),
        scores AS (SELECT id, {token_score('text', TOKEN_LEXICON)} AS score FROM samples)""",
        f"SELECT id, score, {sign_class('score')} AS sentiment FROM scores",
    ),
    "lexicon_score_conversations": (
        f"SELECT conv_id, turn, CAST({token_score('text', TOKEN_LEXICON)} AS INTEGER) AS score FROM conversations"
    ),
    "substring_score": with_ctes(
        f"{DOCS}, scores AS (SELECT id, {substring_score('text', CORPUS_LEXICON)} AS score FROM docs)",
        f"SELECT id, score, {sign_class('score')} AS sentiment FROM scores",
    ),
    "substring_score_join": with_ctes(
        f"{DOCS}, scores AS (SELECT id, CAST({substring_score('text', CORPUS_LEXICON)} AS BIGINT) AS score FROM docs)",
        f"SELECT id, score, {sign_class('score')} AS sentiment FROM scores",
    ),
    "substring_score_vocabulary": with_ctes(
        f"{DOCS}, parts AS (SELECT string_split(lower(text), ' ') AS w FROM benchmark), "
        "every_word AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS word FROM parts), "
        "lexicon AS (SELECT DISTINCT word, length(word) % 5 - 2 AS weight FROM every_word WHERE word <> ''), "
        "scores AS (SELECT id, CAST(CASE WHEN text IS NOT NULL THEN (SELECT coalesce(sum(weight), 0) FROM lexicon WHERE contains(lower(docs.text), word)) END AS BIGINT) AS score FROM docs)",
        f"SELECT id, score, {sign_class('score')} AS sentiment FROM scores",
    ),
    "word_vector_facts": with_ctes(
        f"{STEMS}, words AS (SELECT unnest(stems) AS word FROM stems)",
        f"SELECT word, count(*) AS n, {WORD2VEC_SIZE} AS size, true AS sound FROM words GROUP BY word HAVING count(*) >= {WORD2VEC_MIN_COUNT}",
    ),
    "document_vector_facts": with_ctes(
        f"{STEMS}, words AS (SELECT id, unnest(stems) AS word FROM stems), "
        f"frequent AS (SELECT word FROM words GROUP BY word HAVING count(*) >= {WORD2VEC_MIN_COUNT}), "
        "found AS (SELECT DISTINCT id FROM words WHERE word IN (SELECT word FROM frequent))",
        f"SELECT id, {WORD2VEC_SIZE} AS size, id IN (SELECT id FROM found) AS known FROM stems",
    ),
    "stream_score_table": with_ctes(
        f"{DOCS}, scores AS (SELECT id, CAST({substring_score('text', CORPUS_LEXICON)} AS BIGINT) AS score FROM docs)",
        f"SELECT id, score, {sign_class('score')} AS sentiment FROM scores",
    ),
    "stream_top_words": with_ctes(
        f"{DOCS}, {counts('cleaned')}",
        "SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS rank, true AS sure FROM counts QUALIFY rank <= 20",
    ),
    "unique_words_sketched": with_ctes(
        f"{DOCS}, words AS (SELECT DISTINCT source, unnest({WORDS['letters']}) AS word FROM docs)",
        "SELECT source, count(*) AS unique_words, true AS near FROM words GROUP BY source "
        "UNION ALL SELECT 'all', count(DISTINCT word), true FROM words",
    ),
    "land_verified": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS n, count(*) AS landed, true AS same FROM {name}"
        for name in ("documents", "labels", "conversations", "benchmark", "events", "pages", "embeddings", "part")
    ),
    "train_facts": with_ctes(
        VALID,
        f"SELECT model_name, (SELECT count(*) FILTER ({SPLIT} = 'test') FROM valid) AS n, true AS known, true AS fits "
        f"FROM (SELECT unnest({sql_list(MODEL_NAMES)}) AS model_name)",
    ),
    "batch_predict_facts": with_ctes(
        VALID, f"SELECT id, label AS actual_label, true AS known, true AS two FROM valid WHERE {SPLIT} = 'test'"
    ),
    "cross_validate_facts": "SELECT 'Linear SVM' AS model_name, true AS accuracy, true AS precision, true AS recall, true AS f1",
    "substring_score_messages": with_ctes(
        f"{MESSAGES}, scores AS (SELECT event_id, text, {substring_score('text', STREAM_LEXICON)} AS score FROM messages)",
        f"SELECT event_id, text, score, {sign_class('score')} AS sentiment FROM scores",
    ),
    "keyword_predict": with_ctes(
        MESSAGES,
        f"SELECT event_id, text, CASE WHEN {contained('text', KEYWORDS)} > 0 THEN 'Positive' ELSE 'Negative' END AS sentiment, "
        f"CAST({KEYWORD_CONFIDENCE} AS DOUBLE) AS confidence FROM messages",
    ),
    "confidence_predict": with_ctes(
        f"{MESSAGES}, hits AS (SELECT event_id, text, {contained('text', CONFIDENCE_WORDS)} AS h FROM messages)",
        "SELECT event_id, text, CASE WHEN h > 0 THEN 'Positive' ELSE 'Negative' END AS sentiment, "
        "CAST(h + 5 AS DOUBLE) / 10 AS confidence FROM hits",
    ),
    "keyword_predict_documents": with_ctes(
        DOCS,
        f"SELECT id, CASE WHEN {contained('text', KEYWORDS)} > 0 THEN 'Positive' ELSE 'Negative' END AS sentiment, "
        f"CAST({KEYWORD_CONFIDENCE} AS DOUBLE) AS confidence FROM docs",
    ),
    "confidence_predict_documents": with_ctes(
        f"{DOCS}, hits AS (SELECT id, {contained('text', CONFIDENCE_WORDS)} AS h FROM docs)",
        "SELECT id, CASE WHEN h > 0 THEN 'Positive' ELSE 'Negative' END AS sentiment, CAST(h + 5 AS DOUBLE) / 10 AS confidence FROM hits",
    ),
    "partition_balance": "SELECT count(*) AS n, true AS sound FROM documents",
    "unique_words_error": with_ctes(f"{DOCS}, {counts('letters')}", "SELECT count(*) AS unique_words, true AS near FROM counts"),
    "hashing_tf_totals": with_ctes(
        f"{VALID_STEMS}", f"SELECT id, label, {SPLIT} AS split, len(stems) AS stems FROM valid_stems"
    ),
    "feature_facts": with_ctes(VALID, f"SELECT id, label, {SPLIT} AS split, CAST({WORD2VEC_SIZE} AS INTEGER) AS size, true AS sound FROM valid"),
    "reload_facts": with_ctes(VALID, f"SELECT id, label, true AS same FROM valid WHERE {SPLIT} = 'test'"),
    "sentiment_counts": with_ctes(SCORED, "SELECT sentiment, count(*) AS n FROM scored GROUP BY sentiment"),
    "published_set": with_ctes(SCORED, "SELECT sentiment, count(*) AS n, count(*) AS rows FROM scored GROUP BY sentiment"),
    "sentiment_pivot": with_ctes(
        SCORED,
        "SELECT count(*) FILTER (sentiment = 'Positive') AS positive, count(*) FILTER (sentiment = 'Negative') AS negative, "
        "count(*) FILTER (sentiment = 'Neutral') AS neutral, count(*) AS total FROM scored",
    ),
    "sentiment_trends": with_ctes(
        EVENTS,
        'SELECT sentiment AS label, count(*) AS "count", round(100.0 * count(*) / sum(count(*)) OVER (), 1)::DOUBLE AS percentage '
        "FROM scored GROUP BY sentiment",
    ),
    "daily_trend": with_ctes(
        f"{EVENTS}, span AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM scored), "
        "days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span)",
        "SELECT day, count(*) FILTER (sentiment = 'Positive') AS positive, count(*) FILTER (sentiment = 'Negative') AS negative "
        "FROM days LEFT JOIN scored ON CAST(ts AS DATE) = day GROUP BY day",
    ),
    "kpi_summary": with_ctes(
        f"{POSTS}, k AS (SELECT count(*) AS total, count(*) FILTER (polarity = 4) AS positive, "
        "count(*) FILTER (polarity = 0) AS negative FROM posts)",
        "SELECT *, round(100.0 * positive / total, 1)::DOUBLE AS pct_positive, round(100.0 * negative / total, 1)::DOUBLE AS pct_negative FROM k",
    ),
    "source_polarity_counts": with_ctes(
        VALID, "SELECT source, polarity, count(*) AS n FROM valid GROUP BY ALL ORDER BY source, polarity"
    ),
    "source_label_rollup": with_ctes(
        VALID,
        "SELECT source, polarity, count(*) AS n, CAST(grouping(source, polarity) AS INTEGER) AS level "
        "FROM valid GROUP BY ROLLUP (source, polarity)",
    ),
    "recent_predictions": with_ctes(
        EVENTS, "SELECT event_id, ts, sentiment FROM scored ORDER BY ts DESC, event_id LIMIT 20"
    ),
    "preview": with_ctes(POSTS, "SELECT id, left(text, 50) AS snippet FROM posts ORDER BY id LIMIT 5"),
    "throughput_report": """
        WITH runs AS (SELECT event_type AS method, count(*) AS records, sum(value) AS seconds FROM events GROUP BY ALL),
        base AS (SELECT seconds AS s, records / seconds AS t FROM runs WHERE method = 'view')
        SELECT method, records, round(seconds, 6) AS seconds, round(records / seconds, 6) AS throughput,
               round(s / seconds, 6) AS speedup, round((records / seconds / t - 1) * 100, 6) AS gain_pct
        FROM runs, base""",
    "classification_metrics": with_ctes(
        f"{LEXICON_PREDICTIONS}, predictions AS (SELECT 'lexicon' AS model_name, 0 AS position, label, "
        f"CASE WHEN score < 0 THEN 0 ELSE 1 END AS prediction FROM lex), {METRIC_ROWS}",
        "SELECT accuracy, precision, recall, f1 FROM metrics",
    ),
    "auc_roc": with_ctes(f"{LEXICON_PREDICTIONS}, {auc('lex').strip()}", ""),
    "auc_roc_values": with_ctes(
        "ev AS (SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, value AS score FROM events), "
        + auc("ev").strip(),
        "",
    ),
    "best_model": with_ctes(HEURISTICS, "SELECT model_name, f1 FROM metrics ORDER BY f1 DESC, position LIMIT 1"),
    "model_comparison": with_ctes(HEURISTICS, LONG_METRICS),
    "model_metadata": with_ctes(
        HEURISTICS,
        "SELECT model_name AS best_model, f1 AS best_f1, accuracy AS best_accuracy, "
        f"(SELECT count(*) FROM metrics) AS total_models_trained, {CV_FOLDS} AS cv_folds, "
        "'tfidf_features' AS feature_column, '1.0' AS version FROM metrics ORDER BY f1 DESC, position LIMIT 1",
    ),
    "metrics_json_roundtrip": with_ctes(HEURISTICS, LONG_METRICS),
    "published_predictions": with_ctes(
        f"{VALID}, words AS (SELECT id, label, regexp_split_to_array(lower(text), '[{SPACE}]+') AS w FROM valid), "
        "hits AS (SELECT id, label, "
        + ", ".join(
            f"CAST(len(list_filter(w, lambda x: x IN {in_list(k for k, v in CORPUS_LEXICON.items() if v == n)})) AS INTEGER) AS {c}"
            for n, c in ((-1, "score_neg"), (1, "score_pos"))
        )
        + " FROM words)",
        "SELECT id, label AS actual_label, CASE WHEN score_pos >= score_neg THEN 1 ELSE 0 END AS predicted_label, "
        "score_neg, score_pos FROM hits",
    ),
    "csv_roundtrip": with_ctes(POSTS, "SELECT id, polarity, text FROM posts"),
    "quarantine": """
        WITH lines AS (
            SELECT concat_ws(',', CASE WHEN quality = 0 THEN 'n/a' WHEN toxic = 0 THEN '4' WHEN toxic = 1 THEN '0' END,
                             CAST(d.doc_id AS VARCHAR), lang, source, CAST(n_chars AS VARCHAR), text) AS line
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
        parts AS (SELECT line, string_split(line, ',') AS f FROM lines),
        typed AS (SELECT *, TRY_CAST(replace(f[1], '"', '') AS INTEGER) AS pol,
                         replace(array_to_string(f[6:], ','), '"', '') AS txt FROM parts)
        SELECT CASE WHEN len(f) < 6 THEN 'too_few_fields' WHEN pol IS NULL THEN 'bad_polarity'
                    WHEN pol NOT IN (0, 4) THEN 'unknown_polarity' WHEN txt = '' THEN 'empty_text' ELSE 'valid' END AS reason,
               count(*) AS n
        FROM typed GROUP BY 1""",
    "partitioned_write": with_ctes(
        f"{VALID}, t AS (SELECT label, {token_list(cleaned('text'))} AS tokens FROM valid)",
        "SELECT label, count(*) AS n, CAST(sum(len(tokens)) AS BIGINT) AS stems FROM t GROUP BY label",
    ),
    "land_raw_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS n, count(*) AS landed FROM {t}"
        for t in ("documents", "labels", "conversations", "benchmark", "events", "pages")
    ),
    "multi_source_union": """
        SELECT source, count(*) AS n, count(lang) AS with_lang, CAST(sum(length(text)) AS BIGINT) AS chars FROM (
            SELECT 'documents' AS source, text, lang FROM documents
            UNION ALL SELECT 'conversations', text, NULL FROM conversations
            UNION ALL SELECT 'benchmark', text, NULL FROM benchmark) GROUP BY source""",
    "synthetic_multi_source": """
        SELECT event_type AS source, CASE WHEN event_id % 2 = 0 THEN 4 ELSE 0 END AS polarity, count(*) AS n,
               min(event_type || '_' || CAST(event_id AS VARCHAR)) AS first_id,
               max('tweet from ' || event_type || ' #' || CAST(event_id AS VARCHAR)) AS last_text
        FROM events GROUP BY 1, 2""",
    "message_encode": with_ctes(MESSAGES, 'SELECT event_id, text, "user", "timestamp" FROM messages'),
    "events_props_json": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "parse_post_date": "SELECT event_id, date_trunc('second', ts) AS posted FROM events",
    "model_slug": "SELECT p_partkey, replace(lower(p_name), ' ', '_') AS slug FROM part",
    "train_test_split": with_ctes(
        DOCS, f"SELECT id, CASE WHEN {bucket('id', 100)} < {TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS split FROM docs"
    ),
    "keyed_sample": with_ctes(DOCS, f"SELECT id FROM docs WHERE {bucket('id', 10000, 'sample')} < 500"),
    "fold_assignment": with_ctes(
        DOCS, f"SELECT id, CAST({bucket('id', CV_FOLDS, 'fold')} AS INTEGER) AS fold FROM docs"
    ),
    "tfidf_terms": with_ctes(
        f"{STEMS}, split AS (SELECT id, stems, CASE WHEN {bucket('id', 100)} < {TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS split FROM stems), "
        "pairs AS (SELECT id, split, term, count(*) AS tf FROM (SELECT id, split, unnest(stems) AS term FROM split) GROUP BY ALL), "
        "df AS (SELECT term, count(*) AS df FROM pairs WHERE split = 'train' GROUP BY term)",
        "SELECT id, split, term, tf, round(tf * CASE WHEN df >= "
        f"{MIN_DOC_FREQ} THEN ln(((SELECT count(*) FROM split WHERE split = 'train') + 1) / (df + 1)) ELSE 0 END, 6) AS tfidf "
        "FROM pairs JOIN df USING (term)",
    ),
    "bigrams": with_ctes(
        f"{STEMS}, flat AS ({positions('stems', 'id', 'stems', 'stem')}), "
        "pairs AS (SELECT id, pos, stem || ' ' || lead(stem) OVER (PARTITION BY id ORDER BY pos) AS bigram FROM flat)",
        "SELECT id, pos, bigram FROM pairs WHERE bigram IS NOT NULL",
    ),
    "bigram_vocabulary": with_ctes(
        f"{STEMS}, flat AS ({positions('stems', 'id', 'stems', 'stem')}), "
        "pairs AS (SELECT id, stem || ' ' || lead(stem) OVER (PARTITION BY id ORDER BY pos) AS bigram FROM flat), "
        "counts AS (SELECT bigram, count(DISTINCT id) AS df, count(*) AS n FROM pairs WHERE bigram IS NOT NULL "
        f"GROUP BY bigram HAVING df >= {BIGRAM_MIN_DOCS})",
        "SELECT bigram, df, n, CAST(row_number() OVER (ORDER BY n DESC, bigram) AS INTEGER) AS rank FROM counts "
        f"QUALIFY rank <= {BIGRAM_VOCABULARY}",
    ),
    "mean_embedding": """
        WITH flat AS (SELECT label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                             CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
        SELECT label, pos, round(avg(x), 6) AS mean FROM flat GROUP BY label, pos""",
    "stream_parse": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "stream_score": with_ctes(
        f"{DOCS}, scores AS (SELECT id, {substring_score('text', CORPUS_LEXICON)} AS score FROM docs)",
        f"SELECT id, score, {sign_class('score')} AS sentiment FROM scores",
    ),
    "stream_append": with_ctes(
        f"{MESSAGES}, scores AS (SELECT *, {substring_score('text', STREAM_LEXICON)} AS score FROM messages)",
        f'SELECT event_id, text, "user", "timestamp", score, {sign_class("score")} AS sentiment FROM scores',
    ),
    "stream_sentiment_counts": with_ctes(EVENTS, "SELECT sentiment, count(*) AS n FROM scored GROUP BY sentiment"),
    "stream_trend_tumbling": with_ctes(
        EVENTS,
        "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, sentiment, count(*) AS n FROM scored GROUP BY ALL",
    ),
    "stream_trend_sliding": with_ctes(
        EVENTS + ", slides AS (SELECT date_trunc('day', ts)::TIMESTAMP - INTERVAL 1 DAY * unnest([0, 1]) AS window_start, "
        "sentiment FROM scored)",
        "SELECT window_start, sentiment, count(*) AS n FROM slides GROUP BY ALL",
    ),
    "stream_dedup": "SELECT event_id, event_type FROM events",
}
