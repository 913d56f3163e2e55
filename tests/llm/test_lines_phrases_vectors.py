"""Line deduplication, collocations and whitening against plain forms of their definitions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL, rows
from hard_rows import hard_docs, no_docs  # noqa: F401

from wordtide.llm import collocations as phrases
from wordtide.llm.collocations import collocations, parse_dictionary
from wordtide.llm.common import table
from wordtide.llm.feast import count_above, greatest_pairs
from wordtide.llm.line_dedup import dedup_lines
from wordtide.llm.whitening import fit_whitening, identity_error, whiten_embeddings

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Lines


def plain_dedup(docs, min_chars=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\v\f\r").translate(ASCII_LOWER)
    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        gone = [len(h := holders.get(key(x), ())) >= min_docs and max(h) != doc for x in lines]
        out.append((doc, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=repr)


SHARED = "Ärger, this LINE stands in many documents, " + "x" * 20
ASCII_SHARED = "This line of plain letters stands in MANY documents."


def lined_docs():
    random.seed(5)
    pool = [SHARED, SHARED.lower(), f" \t{SHARED}\r", ASCII_SHARED, f"\f{ASCII_SHARED.upper()}\v", "short", "", "y" * 40, "y" * 39, "ÀÉ" * 20, "àé" * 20, f" {ASCII_SHARED}"]
    docs = [(i, "\n".join(random.choice(pool) for _ in range(random.randrange(1, 9)))) for i in range(60)]
    docs += [(61, None), (62, ""), (None, SHARED), (None, f"a\n{SHARED}\nb"), (63, SHARED + "\n" + SHARED), (63, "other\n" + ASCII_SHARED), (2**53 + 1, "y" * 40), (3, docs[3][1])]
    return docs


def test_lines_equal_the_plain_form(spark):
    docs = lined_docs()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert rows(dedup_lines(df), "doc_id", "n_lines", "n_dropped", "text") == plain_dedup(docs)


def test_lines_below_the_threshold_stay(spark):
    docs = [(i, f"{'z' * 40}\nown {i}") for i in range(4)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows(dedup_lines(df), "doc_id", "n_lines", "n_dropped", "text") == plain_dedup(docs)
    assert sum(r[2] for r in rows(dedup_lines(df, min_docs=2))) == 3


def test_lines_of_hard_rows(spark, hard_docs, no_docs):
    docs = [tuple(r) for r in hard_docs.select("doc_id", "text").collect()]
    assert rows(dedup_lines(hard_docs, 5, 1), "doc_id", "n_lines", "n_dropped", "text") == plain_dedup(docs, 5, 1)
    assert dedup_lines(no_docs).count() == 0


def test_text_moves_only_to_meet_its_lines(spark):
    text = dedup_lines(table(spark, SMALL, "documents"))._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in text and text.count("Join") == 1


# Phrases


def plain_collocations(docs, least, top):
    grams, sizes = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(ASCII_LOWER)):
            words = [w for w in re.split(r"[ \t]", piece) if w]
            sizes[lang] += len(words)
            for k in range(1, 5):
                grams[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            inside = (q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if not any(100 * found[q] >= 80 * a for q in inside):
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out, key=repr)


def phrase_docs():
    random.seed(8)
    vocabulary = ["the", "The", "of", "new", "york", "city", "in", "é", "Ärger", "a-b", " x", "日本", "(x)"]
    fixed = ["new york city hall", "in the new york city hall of", "of of of of of of", "The End"]
    out = []
    for i in range(300):
        parts = [random.choice(fixed) if random.random() < 0.3 else random.choice(vocabulary) for _ in range(random.randrange(30))]
        out.append((random.choice(["en", "de", None, ""]), "".join(p + random.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "!?"]) for p in parts)))
    return out + [("en", out[0][1])] * 50 + [("en", None), ("en", ""), ("zz", "?!"), (None, "word " * 5000)]


@pytest.mark.parametrize("least,top", [(30, 2000), (3, 40)])
def test_phrases_equal_the_plain_form(spark, least, top):
    docs = phrase_docs()
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    want = plain_collocations(docs, least, top)
    assert len(want) > 20
    assert rows(collocations(df, least, top), "lang", "rank", "phrase", "a", "l", "r", "n", "score") == want


def test_a_full_bit_table_changes_nothing(spark, monkeypatch):
    docs = phrase_docs()
    df = spark.createDataFrame(docs, "lang string, text string")
    monkeypatch.setattr(phrases, "MOST_BITS", 15)
    monkeypatch.setattr(phrases, "AT_ONCE", 2000)
    assert rows(collocations(df, 3, 500), "lang", "rank", "phrase", "a", "l", "r", "n", "score") == plain_collocations(docs, 3, 500)


def test_equal_passages_are_parsed_alike(spark):
    random.seed(2)
    passage = " ".join(f"w{random.randrange(500)}" for _ in range(400))
    docs = [("en", f"own{i} start {passage} end{i}") for i in range(50)]
    dictionary = parse_dictionary(spark.createDataFrame(docs, "lang string, text string")).collect()
    # All but the ends of the passage is in the dictionary once.
    assert sum(r.owned * r.freq for r in dictionary) == sum(len(t.split()) for _, t in docs)
    assert sum(r.owned for r in dictionary) < 400 + 50 * 4 * phrases.TRIGGER
    assert max(r.freq for r in dictionary) == 50


def test_words_are_counted_by_the_parse(spark, monkeypatch):
    docs = [("en", "One two. two,THREE"), (None, "two é"), ("en", None), ("de", ",; "), ("de", "one\tone")] + [(f"l{k}", f"w{k} of") for k in range(40)]
    want = Counter((lang or "und", w) for lang, t in docs for w in re.split(r"[.,;\s]+", (t or "").translate(ASCII_LOWER)) if w)
    for at_once in (1, 10**6):
        monkeypatch.setattr(phrases, "AT_ONCE", at_once)
        dictionary, words = phrases.parse_texts(spark.createDataFrame(docs, "lang string, text string").coalesce(1))
        assert rows(words, "lang", "phrase", "f") == sorted(((*k, f) for k, f in want.items()), key=repr)
        assert dictionary.where("owned < 1").count() == 0


def test_phrases_of_hard_rows(spark, hard_docs, no_docs):
    docs = [tuple(r) for r in hard_docs.select("lang", "text").collect()]
    assert rows(collocations(hard_docs, 2), "lang", "rank", "phrase", "a", "l", "r", "n", "score") == plain_collocations(docs, 2, 2000)
    assert collocations(no_docs).count() == 0


# Vectors


def spectrum(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    a = (q * np.asarray(values, float)) @ q.T
    return (a + a.T) / 2


SPECTRA = {
    "spread": np.arange(1, 65) ** 2.0,
    "equal": np.r_[[5.0] * 20, [1.0] * 30, [0.0] * 14],
    "near": 1 + 1e-9 * np.arange(64),
    "one": np.r_[3.0, np.zeros(63)],
    "wide": np.r_[1e9, np.ones(40), np.zeros(23)],
    "negative": np.arange(-10.0, 10),
    "small": [2.0],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_contour_integration_finds_the_greatest_pairs(name):
    a = spectrum(SPECTRA[name])
    top = min(32, len(a))
    values, vectors = greatest_pairs(a, top)
    scale = np.abs(a).max()
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:top], rtol=0, atol=1e-12 * scale)
    assert np.abs(vectors.T @ vectors - np.eye(top)).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-11 * scale


def test_inertia_counts():
    for name, values in SPECTRA.items():
        a = spectrum(values)
        for shift in (-3.3, 0.4, 2.7, 700.5):
            assert count_above(a, shift) == (np.asarray(values) > shift).sum(), (name, shift)
    assert count_above(np.array([[0.0, 1], [1, 0]]), 0) == 1
    assert greatest_pairs(np.zeros((5, 5)), 3)[0].size == 0


def plain_whitening(kept):
    """vec_id, deviation and, by component, explained and whitened up to the sign."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    off = ((x * n - s) / n).astype(float)
    cov = np.array([[sum(a * b for a, b in zip(x[:, i] * n - s[i], x[:, j] * n - s[j])) / n**3 for j in range(x.shape[1])] for i in range(x.shape[1])], float)
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    return [(k, int(((x[i] * n - s) ** 2).sum())) for i, (k, _) in enumerate(kept)], e / e.sum(), off @ u / np.sqrt(e)


def check_whitening(df, kept, components):
    got = df.collect()
    ids, explained, white = plain_whitening(kept)
    assert len(got) == len(kept) * components
    by = defaultdict(list)
    for r in got:
        by[r.component].append(((r.vec_id, r.deviation), r.whitened, r.explained, r.n))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8
    for c in range(1, components + 1):
        mine = sorted(by[c], key=repr)
        want = sorted(zip(ids, white[:, c - 1]), key=repr)
        assert [m[0] for m in mine] == sorted(ids, key=repr) and all(m[3] == len(kept) for m in mine)
        sign = 1 if sum(m[1] * w[1] for m, w in zip(mine, want)) > 0 else -1
        # Rows with equal keys may come in any order.
        assert np.allclose(sorted(m[1] * sign for m in mine), sorted(w[1] for w in want), atol=1e-8)
        assert all(abs(m[2] / explained[c - 1] - 1) < 1e-9 for m in mine)


def test_whitening_equals_the_plain_form(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((120, 9)) * np.arange(1, 10) / 3).tolist()
    nan, inf = float("nan"), float("inf")
    good = list(enumerate(vectors)) + [(2**53 + 1, vectors[0]), (None, vectors[1]), (None, vectors[1]), (7, vectors[2])]
    bad = [(900, None), (901, [None] + vectors[0][1:]), (902, [nan] + vectors[0][1:]), (903, vectors[0][:-1] + [-inf]), (904, vectors[0][:-1]), (905, []), (906, [1e30] + vectors[0][1:])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in good + bad], "vec_id bigint, embedding array<double>, component int, _vectors string").repartition(3)
    check_whitening(whiten_embeddings(df), good, 9)


def test_whitening_of_the_table(spark):
    df = table(spark, SMALL, "embeddings")
    kept = [(r.vec_id, r.embedding) for r in df.collect()]
    # 64 dimensions and fewer vectors than that leave fewer directions.
    assert whiten_embeddings(df).count() == len(kept) * min(32, len(kept) - 1)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(6)
    vectors = [[float(a) * 2**40, float(b)] for a, b in rng.integers(-50, 50, (40, 2))]
    vectors += [[float(a) * 2**40 + 3, float(a) * 2**40 - 5] for a in range(20)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")
    model = fit_whitening(df)
    x = [[math.floor(64 * c) for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    assert list(model.sums) == sums
    want = {i: sum((60 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r.vec_id: r.deviation for r in whiten_embeddings(df).collect()} == {i: v if v < 2**63 else None for i, v in want.items()}
    assert identity_error(df, model) < 1e-6


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, None], [[]]])
def test_nothing_to_whiten(spark, vectors):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    assert whiten_embeddings(df).collect() == []


def test_digest_of_kept_text(spark):
    import __spark_entry__ as entry

    got = {r.doc_id: r.kept_sha256 for r in entry.queries()["op12_line_dedup"](spark, SMALL).collect()}
    docs = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert got == {d: hashlib.sha256(t.encode()).hexdigest() for d, _, _, t in plain_dedup(docs)}
