"""Near copies against comparing every two texts."""

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from wordtide.llm import near_copies as nc


def words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def plain_groups(texts, least=0.8):
    sets = [shingles(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= least:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def edited(rng, text, times):
    out = text.split()
    for _ in range(times):
        out[rng.randrange(len(out))] = f"z{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed, sizes=(12, 60, 200, 900)):
    rng = random.Random(seed)
    texts = []
    for size in sizes:
        for _ in range(6):
            base = " ".join(f"w{rng.randrange(4000)}" for _ in range(size))
            texts += [base, base.upper(), *(edited(rng, base, k) for k in (1, 1, max(1, size // 60), size // 45 + 1, size // 20 + 1, size // 4))]
    return texts


def frame(spark, texts, extra=""):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return docs.selectExpr("*", *([extra] if extra else []))


def test_links_are_those_of_all_pairs():
    rng = random.Random(5)
    for _ in range(30):
        sets = []
        for _ in range(6):
            base = [rng.randrange(500) for _ in range(rng.randrange(5, 30))]
            sets += [np.unique(np.array(base + [rng.randrange(500) for _ in range(k)], "u8")) for k in (0, 1, 2, 4)]
        group = list(range(len(sets)))
        for i, j in nc.alike_links(sets):
            old, new = max(group[i], group[j]), min(group[i], group[j])
            group = [new if g == old else g for g in group]
        plain = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if 10 * len(a & b) >= 8 * len(a | b):
                    old, new = max(plain[i], plain[j]), min(plain[i], plain[j])
                    plain = [new if g == old else g for g in plain]
        assert group == plain


@pytest.mark.parametrize("shard", [4, 4_096])
def test_groups_equal_those_of_all_pairs(spark, monkeypatch, shard):
    monkeypatch.setattr(nc, "SUSPECTS", shard)
    texts = corpus(1)
    got = {r.doc_id: r.component for r in nc.near_copies(frame(spark, texts)).collect()}
    want = plain_groups(texts)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if want[i] == want[j]]
    found = sum(got[i] == got[j] for i, j in pairs)
    # A link between unlike texts is never made; of the others nearly all are found.
    assert all(want[i] == want[j] for i in range(len(texts)) for j in range(i) if got[i] == got[j])
    assert len(pairs) > 200 and found >= 0.99 * len(pairs)


def test_unlike_texts_with_one_fingerprint_stay(spark):
    # One line rules both fingerprints, if repeats are counted; the sets of shingles differ.
    line = "the very same line over and over again "
    texts = [line * 300 + " ".join(f"{p}{i}" for i in range(200)) for p in "ab"]
    assert nc.one_of_near_copies(frame(spark, texts)).count() == 2


def test_hard_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame(
        [(2**53 + 1, text, 1), (2**53 + 3, text + " more", 2), (None, text, 3), (None, text, 4), (7, None, 5), (8, "", 6), (9, " \t\n", 7), (10, "a b", 8), (11, "A  b", 9),
         (12, "a c", 10), (12, "a d", 11), (12, "a d", 11), (2**63 - 1, "x " * 200_000, 12)],
        "doc_id long, text string, digest int",
    ).withColumn("rep", F.lit("x"))
    kept = nc.one_of_near_copies(docs)
    assert kept.columns == docs.columns
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.digest) for r in kept.collect())
    assert got == [(-1, 3), (-1, 4), (7, 5), (10, 8), (12, 10), (12, 11), (2**53 + 1, 1), (2**63 - 1, 12)]
    assert nc.near_copies(docs).count() == docs.count()
    assert rows(nc.one_of_near_copies(docs.where("false"))) == []


def test_no_similar_documents_stay(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    before = {r.doc_id: shingles(r.text or "") for r in docs.collect()}
    after = {r.doc_id for r in nc.one_of_near_copies(docs).select("doc_id").collect()}
    ids = sorted(before)
    alike = [(i, j) for n, i in enumerate(ids) for j in ids[:n] if similarity(before[i], before[j]) >= 0.8]
    linked = {x for pair in alike for x in pair}
    assert set(ids) - linked <= after
    assert sum(i in after and j in after for i, j in alike) <= 0.02 * len(alike)


def test_only_suspects_shingles_are_written_and_shuffled(spark, monkeypatch):
    """Sets of texts that resemble no other are never written, and repeated rows fold wherever the map of keys puts them."""
    written, stage = {}, nc.stage
    monkeypatch.setattr(nc, "stage", lambda df, name: written.setdefault(name, stage(df, name)))
    rng = random.Random(8)
    alone = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(50)]
    docs = frame(spark, [*alone, alone[7].upper(), None, alone[9]], "CAST(doc_id AS STRING) AS _bucket")
    docs = docs.unionByName(docs.where("doc_id IN (3, 9)")).unionByName(docs.where("doc_id < 2").withColumn("doc_id", F.lit(None).cast("long")))
    got = rows(nc.one_of_near_copies(docs), "doc_id", "_bucket")
    assert got == sorted([*((i, str(i)) for i in range(50)), (51, "51"), (None, "0"), (None, "1")], key=repr)
    assert all(kind != "binary" for _, kind in written["described"].dtypes)
    assert written["suspects"].count() == 0
