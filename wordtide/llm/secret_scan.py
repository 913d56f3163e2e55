"""Secret scans: candidate strings, and a random forest that removes false positives.

A candidate is a run of letters, digits and the signs of encoded keys with at least one digit, = only at its end, or
whatever of four characters or more is assigned to a secret's name. Its length, character
transitions, dictionary coverage, path and neighbouring words go to a forest that is trained from labelled findings.
All of it runs in Spark's own expressions: a text is split at its candidates, so that what stands before and after each
is at hand, and put together again when secrets are masked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.llm.common import free_name, let, stage, whole

# A value after a secret's name and a sign of assignment; the plain looks back come first, as the long one is costly.
ASSIGNED_VALUE = (
    r"(?<=[=:>\"'` ])(?=[^\s\"'`=:])(?<=[=:>][\"'` ]{0,3})"
    r"(?<=(?i:token|secret|passwo?r?d|passphrase|pwd|api[_\- ]?key|access[_\- ]?key|private[_\- ]?key|credential|authorization)[A-Za-z0-9_\-]{0,24}[\"']? {0,2}(?::=|=>|[=:]) {0,2}[\"'`]?)"
    r"[^\s\"'`<>,;(){}\[\]&]{3,}[^\s\"'`<>,;(){}\[\]&.:]"
)
# Not the name itself, where it has a digit: a secret's name that something is assigned to.
NAME = r"(?![A-Za-z0-9_\-]*(?i:token|secret|passwo?r?d|passphrase|pwd|api[_\-]?key|access[_\-]?key|private[_\-]?key|credential|authorization)[A-Za-z0-9_\-]*[\"']?(?:[=:][\"'`]?[^\s=]| [=:] ))"
CANDIDATE = ASSIGNED_VALUE + r"|(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*+[0-9])" + NAME + r"[A-Za-z0-9+/_\-]{8,}+(?:={1,2}+(?![A-Za-z0-9+/_\-]))?+"
# Characters looked at on either side for neighbouring words; the text itself is scanned whole.
BEFORE, AFTER = 48, 24
DICTIONARY = 5_000
# Labelled findings that are fitted at most, of each label.
FINDINGS = 5_000
TREES, DEPTH = 20, 6
MASK = "[secret]"

# Fixed patterns for neighbouring words and paths, lower case.
ASSIGNED = r"(token|secret|passwo?r?d|passphrase|pwd|api[_\- ]?key|access[_\- ]?key|private[_\- ]?key|credential|bearer|authorization)[a-z0-9_\-]*[\"']?\s*(:=|=>|[=:]|\s)\s*[\"'`]?$"
HASH_NAMED = r"(commit|sha1|sha256|sha|md5|checksum|digest|etag|revision|uuid|guid|hash|build|version)[a-z0-9_\-]*[\"']?\s*[:=]?\s*[\"'`]?$"
TEST_PATH = r"(test|example|sample|fixture|mock|spec|demo|doc)"
# Keys that their issuers mark by how they begin.
KNOWN_KEY = r"^((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|github_pat_[A-Za-z0-9_]{30,}|glpat-[A-Za-z0-9_\-]{20,}|xox[abprs]-[A-Za-z0-9\-]{10,}|[srp]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_\-]{35})$"
PLACEHOLDER = r"(example|sample|dummy|placeholder|changeme|your|xxxx|0000000|1234567|abcdef)"

FEATURES = [
    "length",
    "digit_share",
    "upper_share",
    "letter_digit_turns",
    "case_turns",
    "distinct_share",
    "longest_letter_run",
    "dictionary_coverage",
    "hex_only",
    "digits_only",
    "quoted",
    "assigned",
    "hash_named",
    "known_key",
    "placeholder",
    "test_path",
    "words_before",
]


def candidates(text: Column) -> Column:
    """The text's candidates in order, as structs of number, start (characters before it), value, before and after."""
    cut = F.struct(F.split(text, CANDIDATE, -1).alias("rest"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found"))

    def listed(x: Column) -> Column:
        lengths = F.zip_with(x["rest"], x["found"], lambda r, f: F.length(r) + F.coalesce(F.length(f), F.lit(0)))
        # Characters up to the start of each candidate, folded from left to right.
        starts = F.aggregate(
            F.slice(lengths, 1, F.size(x["found"])),
            F.array(F.lit(0)),
            lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)),
        )
        one = lambda f, i: F.struct(
            i.alias("number"),
            (F.get(starts, i) + F.length(F.get(x["rest"], i))).alias("start"),
            f.alias("value"),
            # A candidate just before may be the name that this one is assigned to.
            F.right(F.concat(F.coalesce(F.get(x["found"], i - 1), F.lit("")), F.get(x["rest"], i)), F.lit(BEFORE)).alias("before"),
            F.left(F.get(x["rest"], i + 1), F.lit(AFTER)).alias("after"),
        )
        return F.transform(x["found"], one)

    return let(cut, listed)


def path_of(docs: DataFrame) -> Column:
    return F.lower(F.coalesce(F.col("source").cast("string"), F.lit(""))) if "source" in docs.columns else F.lit("")


def findings(docs: DataFrame) -> DataFrame:
    """One row per candidate: doc_id, path, number, start, value, before, after. ``source`` stands for the path."""
    texts = docs.select(F.col("doc_id").cast("bigint"), path_of(docs).alias("path"), whole().alias("text"))
    # Most texts have no candidate; they are not split.
    return texts.where(F.col("text").rlike(CANDIDATE)).select("doc_id", "path", F.inline(candidates(F.col("text"))))


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The ``size`` most frequent words of at least three letters, counted over all texts."""
    words = F.explode(F.split(F.lower(whole()), r"[^\p{L}]+"))
    counts = docs.select(words.alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.length("word") >= 3)
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(size).collect()]


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """Adds the forest's inputs to findings."""
    value, before, low = F.col("value"), F.lower(F.col("before")), F.lower(F.col("value"))
    length = F.length(value)

    def share(pattern: str) -> Column:
        return (length - F.length(F.regexp_replace(value, pattern, ""))) / length

    def turns(pattern: str) -> Column:
        return F.size(F.regexp_extract_all(value, F.lit(pattern), F.lit(0))) / length

    runs = F.filter(F.split(low, "[^a-z]+"), lambda x: F.length(x) >= 3)
    known = F.filter(runs, lambda x: x.isin(words)) if words else F.array().cast("array<string>")
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + F.length(x))
    number = lambda c: c.cast("double")
    return found.select(
        "*",
        number(length).alias("length"),
        share("[0-9]").alias("digit_share"),
        share("[A-Z]").alias("upper_share"),
        turns("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])").alias("letter_digit_turns"),
        turns("[a-z](?=[A-Z])|[A-Z](?=[a-z])").alias("case_turns"),
        (F.size(F.array_distinct(F.split(value, ""))) / length).alias("distinct_share"),
        number(F.array_max(F.transform(F.split(low, "[^a-z]+"), F.length))).alias("longest_letter_run"),
        (total(known) / length).alias("dictionary_coverage"),
        number(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hex_only"),
        number(value.rlike("^[0-9]+$")).alias("digits_only"),
        number(before.rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).alias("quoted"),
        number(before.rlike(ASSIGNED)).alias("assigned"),
        number(before.rlike(HASH_NAMED)).alias("hash_named"),
        number(value.rlike(KNOWN_KEY)).alias("known_key"),
        number(low.rlike(PLACEHOLDER)).alias("placeholder"),
        number(F.col("path").rlike(TEST_PATH)).alias("test_path"),
        number(F.size(F.filter(F.split(before, r"[^\p{L}]+"), lambda x: x != ""))).alias("words_before"),
    )


def seed_findings(spark: SparkSession, n: int = 40) -> DataFrame:
    """Labelled findings made by rule, ``n`` of each kind: keys that are assigned, and what only looks like one."""
    sha = lambda salt: F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    key = F.regexp_replace(F.base64(F.unhex(sha("k"))), "=", "")
    digits = F.substring(F.regexp_replace(sha("d"), "[a-f]", "7"), 1, 16)
    uuid = F.regexp_replace(F.substring(sha("u"), 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    made = [
        (F.substring(sha("t"), 1, 40), 'here token = "', '" and more', "src", 1),
        (F.upper(F.substring(sha("T"), 1, 40)), 'TOKEN = "', '"', "src", 1),
        (key, "api_key: '", "'", "config", 1),
        (F.substring(key, 1, 24), "password=", "\n", "env", 1),
        (F.concat(F.lit("AKIA"), F.upper(F.substring(sha("a"), 1, 16))), "access_key = ", " ", "config", 1),
        (key, "AWS_SECRET_ACCESS_KEY=", "\n", "env", 1),
        (F.substring(sha("q"), 1, 32), "https://host.example/path?token=", "&page", "web", 1),
        (F.concat(F.lit("AKIA"), F.upper(F.substring(sha("b"), 1, 16))), "and the key ", " was found", "docs", 1),
        (F.concat(F.lit("ghp_"), F.substring(key, 1, 36)), "then use ", " for it", "src", 1),
        (F.concat(F.substring(key, 1, 5), F.lit("@"), F.substring(key, 8, 4), F.lit("!.$")), "password: ", " ", "config", 1),
        (F.concat(F.substring(key, 3, 4), F.lit("$"), F.substring(key, 9, 2)), "PASSWORD=", "\n", "env", 1),
        (F.translate(F.substring(sha("w"), 1, 14), "0123456789", "QzXkVwJpGy"), "db_password=", "\n", "env", 1),
        (F.element_at(F.array(*map(F.lit, ("required", "optional", "missing", "expired", "invalid", "string", "None", "true"))), (F.col("id") % 8 + 1).cast("int")), "the password: ", " and", "docs", 0),
        (F.substring(sha("c"), 1, 40), "fixed in commit ", " of main", "src", 0),
        (sha("s"), "sha256: ", "\n", "lock", 0),
        (uuid, "uuid = ", " ", "src", 0),
        (digits, "the number ", " was", "src", 0),
        (F.concat(F.lit("your-token-1234567"), F.col("id").cast("string")), 'token = "', '"', "docs/example", 0),
        (F.concat(F.lit("section-and-part-"), F.col("id").cast("string")), "in the ", " of", "docs", 0),
        (F.concat_ws("-", F.lit("2024-01-01T00"), digits), "on ", " ", "log", 0),
    ]
    rows = spark.range(n)
    parts = [
        rows.select(
            F.lit(path).alias("path"), value.alias("value"), F.lit(before).alias("before"), F.lit(after).alias("after"), F.lit(label).alias("label")
        )
        for value, before, after, path, label in made
    ]
    return reduce(DataFrame.unionByName, parts)


def rule_labels(found: DataFrame, most: int = FINDINGS) -> DataFrame:
    """Labelled findings of a corpus without reviewed ones, at most ``most`` of each label, drawn by hash.

    Sure cases only: a secret is a long mix of digits and letters that is quoted and assigned to a secret's name, or
    begins like a known kind of key; what has digits and signs alone and is not assigned, a placeholder, or the name of a
    hash before it is none. All others, assigned or not, stay without a label.
    """
    before, value = F.lower(F.col("before")), F.col("value")
    known = value.rlike(KNOWN_KEY)
    sure = before.rlike(ASSIGNED) & F.col("after").rlike("^[\"'`]") & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(value) >= 20)
    never = (value.rlike(r"^[0-9+/=_\-]+$") & ~before.rlike(ASSIGNED)) | F.lower(value).rlike(PLACEHOLDER) | before.rlike(HASH_NAMED)
    label = F.when(never, 0).when(sure | known, 1)
    marked = found.select("path", "value", "before", "after", label.alias("label")).where("label IS NOT NULL").distinct()
    order = [F.xxhash64("value", "before"), F.col("value"), F.col("before"), F.col("after"), F.col("path")]
    parts = [marked.where(F.col("label") == x).orderBy(*order).limit(most) for x in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(labelled: DataFrame, words: list[str], trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> RandomForestClassificationModel:
    """A forest from labelled findings: path, value, before, after, label (1: secret). The same rows give the same forest."""
    rows = with_features(labelled, words).select(F.col("label").cast("double"), *FEATURES)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt")
    return forest.fit(stage(rows.repartition(1), "labelled-findings"))


def judge(found: DataFrame, model: RandomForestClassificationModel, words: list[str]) -> DataFrame:
    """Adds ``probability`` and ``is_secret`` to findings."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(found, words))
    judged = model.transform(rows).withColumn("probability", vector_to_array("probability")[1])
    return judged.select(*found.columns, "probability", (F.col("probability") >= 0.5).alias("is_secret"))


def fit_scanner(docs: DataFrame, found: DataFrame, labelled: DataFrame | None = None) -> tuple[RandomForestClassificationModel, list[str]]:
    """Forest and dictionary of a corpus. ``labelled`` are reviewed findings; without them, rule-made ones are used."""
    words = dictionary(docs)
    if labelled is None:
        labelled = seed_findings(docs.sparkSession).unionByName(rule_labels(found))
    return train(labelled, words), words


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, number, start, length, value_sha256, probability, is_secret of every candidate in every text.

    A NULL or empty text has no candidates. Rows that repeat a document repeat its findings. A NULL source is an empty
    path, a NULL id stays NULL, an empty table gives no rows, other columns are not read.
    """
    found = stage(findings(docs), "findings")
    judged = judge(found, *fit_scanner(docs, found, labelled))
    return judged.select(
        "doc_id",
        "number",
        "start",
        F.length("value").alias("length"),
        F.sha2("value", 256).alias("value_sha256"),
        F.round("probability", 6).alias("probability"),
        "is_secret",
    )


def mask_secrets(docs: DataFrame, labelled: DataFrame | None = None, mask: str = MASK) -> DataFrame:
    """The documents with every secret replaced by ``mask`` and ``n_chars`` counted anew; all rows and columns stay.

    Which candidates of a document are secrets is found by their place, joined by id and a digest of the text, so rows
    without an id or with one that repeats are masked by their own text.
    """
    digest, secret = free_name(docs, "_digest"), free_name(docs, "_secret")
    found = stage(
        docs.where(whole().rlike(CANDIDATE)).select(
            path_of(docs).alias("path"),
            F.sha2(whole(), 256).alias(digest),
            F.inline(candidates(whole())),
        ),
        "findings",
    )
    secrets = judge(found, *fit_scanner(docs, found, labelled)).where("is_secret")
    # Copies of a text have the same secrets at the same places; their paths may differ, one verdict is enough.
    places = stage(secrets.groupBy(digest).agg(F.sort_array(F.collect_set("number")).alias(secret)), "secret-places")
    text = whole()
    cut = F.struct(F.split(text, CANDIDATE, -1).alias("rest"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found"))
    masked = let(
        cut,
        lambda x: F.array_join(
            F.transform(
                x["rest"],
                lambda r, i: F.concat(r, F.when(F.array_contains(F.col(secret), i), F.lit(mask)).otherwise(F.coalesce(F.get(x["found"], i), F.lit("")))),
            ),
            "",
        ),
    )
    joined = docs.withColumn(digest, F.sha2(text, 256)).join(places, digest, "left")
    new = F.when(F.col(secret).isNull(), F.col("text")).otherwise(masked)
    columns = [c for c in docs.columns if c not in ("text", "n_chars")]
    shown = joined.select(*columns, new.alias("text"), *(["n_chars", secret] if "n_chars" in docs.columns else []))
    if "n_chars" in docs.columns:
        counted = F.when(F.col(secret).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
        shown = shown.withColumn("n_chars", counted)
    return shown.select(*docs.columns)
