"""Near-duplicates, decontamination, toxicity, secrets, surrogates and sketches against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from conftest import plan, rows
from hard_rows import hard_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from wordtide.llm import decontamination, paragraph_sketch, secret_scan, simhash, surrogates, toxicity
from wordtide.llm.common import let

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def words(n, seed):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


# Near-duplicates


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    bits = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) * 2 > len(shingles) for b in range(64)]
    return sum(1 << b for b, x in enumerate(bits) if x)


def brute_components(ids, fps, radius=3):
    up = {i: i for i in range(len(ids))}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                up[root(i)] = root(j)
    least = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [least.get(root(i)) for i in range(len(ids))]


def test_fingerprints_and_components(spark, hard_docs, no_docs):
    texts = [tuple(r) for r in hard_docs.select("doc_id", "text").collect()]
    fps = [brute_fingerprint(t) for _, t in texts]
    want = sorted(zip([i for i, _ in texts], [f"{f:016x}" for f in fps], brute_components([i for i, _ in texts], fps)), key=repr)
    assert rows(simhash.near_duplicates(hard_docs)) == want
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.one_of_each(hard_docs)
    assert kept.columns == hard_docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect() if r[0]) == sorted({c for i, _, c in want if i is not None and i == c})
    assert kept.where("doc_id IS NULL").count() == 1


@pytest.mark.parametrize("shard", [4, 4096])
def test_links_of_clusters_chains_and_hot_buckets(spark, shard):
    rng = random.Random(1)
    fps = {0, 1 << 63, (1 << 64) - 1}
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 12])):
            fps.add(x)
            for _ in range(rng.choice([1, 2, 3, 4])):
                x ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    signed = np.array(fps, "u8").view("i8").tolist()
    df = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "rep long, fp long")
    found = {r.id: r.component for r in simhash.components(simhash.link_pairs(df, shard=shard)).collect()}
    assert [found.get(i, i) for i in range(len(fps))] == brute_components(list(range(len(fps))), fps)


def test_bk_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 40, dtype="u8")
    values = np.unique(np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 40), rng.integers(0, 2**10, 100, dtype="u8")]))
    tree = simhash.BKTree(values)
    got = {(int(q), node) for near, node in tree.within(values, 3) for q in near}
    assert got == {(i, j) for i in range(len(values)) for j in range(len(values)) if int(values[i] ^ values[j]).bit_count() <= 3}
    assert list(simhash.BKTree(values[:0]).within(values)) == []


# Decontamination


def brute_contamination(docs, items, n=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda t: word.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), t or ""))
    windows = {}
    for item, text in items:
        w = cut(text)
        for k in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    for doc, text in docs:
        w, found = cut(text), set()
        hit = [False] * len(w)
        for size in set(map(len, windows)):
            for k in range(len(w) - size + 1):
                if (some := windows.get(tuple(w[k : k + size]))) is not None:
                    found |= {str(x) for x in some if x is not None}
                    hit[k : k + size] = [True] * size
        yield doc, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)


def leaks():
    items = [(1, words(30, 1)), (2, words(12, 2)), (3, "Solo"), (4, "two words"), (5, None), (6, ""), (7, words(30, 1)), (None, words(11, 9)), (8, "Ünï " + words(10, 5))]
    docs = [(k, f"{words(40, 50 + k)} {(items[k % len(items)][1] or '')} {words(5, k)}") for k in range(20)]
    docs += [(30, words(12, 1)), (31, words(30, 1).upper()), (32, "solo"), (33, "x, Solo; y two-words"), (34, words(9, 2)), (35, items[-1][1])]
    return docs, items


def test_contamination(spark, hard_docs, no_docs, monkeypatch):
    docs, items = leaks()
    docs += [tuple(r) for r in hard_docs.select("doc_id", "text").collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute_contamination(docs, items), key=repr)
    assert rows(decontamination.contamination(frame, bench)) == want
    # Test items in several portions give the same.
    portions = decontamination.load_items(bench, most_bytes=200)
    assert len(portions) > 2
    monkeypatch.setattr(decontamination, "load_items", lambda b: portions)
    assert rows(decontamination.contamination(frame, bench)) == want
    assert decontamination.remove_contaminated(frame, bench).count() == sum(not w[-1] for w in want)


def test_contamination_of_many_shards(monkeypatch):
    import pandas as pd

    docs, items = leaks()
    monkeypatch.setattr(decontamination, "SHARD_CHARS", 300)

    class Sent:
        value = items

    batch = pd.DataFrame(docs, columns=["doc_id", "text"])
    got = pd.concat(decontamination._digest([Sent], 10)(iter([batch])))
    assert [tuple(r) for r in got.itertuples(index=False)] == list(brute_contamination(docs, items))


def test_contamination_without_items_or_documents(spark, hard_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(hard_docs, none).where("contaminated").count() == 0
    assert decontamination.remove_contaminated(hard_docs, none).count() == hard_docs.count()
    assert decontamination.contamination(no_docs, none).count() == 0


def test_longest_verbatim_matches(spark):
    docs, items = leaks()
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = decontamination.verbatim_matches(frame, spark.createDataFrame(items, "item_id long, text string"), least=10)
    cut = {d: decontamination.words_of(t) for d, t in docs}
    by_item = {str(i): decontamination.words_of(t) for i, t in items if t and i is not None}
    found = {(r.item_id, r.item_start): r for r in got.collect() if r.item_id is not None}
    for item, w in by_item.items():
        for s in range(len(w)):
            def shared(a, b):
                n = 0
                while n < min(len(a), len(b)) and a[n] == b[n]:
                    n += 1
                return n

            best = max(shared(w[s:], d[p:]) for d in cut.values() for p in range(len(d)))
            if best < 10:
                assert (item, s) not in found
                continue
            r = found[item, s]
            assert r.n_words == best
            assert cut[r.doc_id][r.doc_start : r.doc_start + best] == w[s : s + best]
            assert r.n_locations == sum(d[p : p + best] == w[s : s + best] for d in cut.values() for p in range(len(d)))


# Toxicity


@pytest.fixture(scope="module")
def toxic_docs(spark):
    rng = random.Random(4)
    made = []
    for k in range(900):
        toxic = k % 4 == 0
        text = [rng.choice(WORDS) for _ in range(rng.randint(3, 80))]
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["grbl", "snork"]) + rng.choice(["ing", "ed", "er", ""]))
        made.append((k, " ".join(text), "en" if k % 3 else None, int(toxic)))
    return spark.createDataFrame(made, "doc_id long, text string, lang string, toxic int")


def test_toxicity_learns_and_never_from_held_out_labels(spark, toxic_docs, hard_docs, no_docs):
    docs, labels = toxic_docs.drop("toxic"), toxic_docs.select("doc_id", "toxic")
    model = toxicity.fit_model(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [i for i in got if got[i].held_out]
    assert set(held) == {i for i in got if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    flipped = labels.withColumn("toxic", F.when(toxicity.may_learn(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score_documents(docs, toxicity.fit_model(docs, flipped)).collect()}
    assert all(again[i] == got[i].score for i in got)
    relabelled = toxicity.score_documents(docs.withColumn("lang", F.lit("xx")), model)
    assert all(got[r.doc_id].score == r.score for r in relabelled.collect())
    assert toxicity.score_documents(hard_docs, model).count() == hard_docs.count()
    assert toxicity.score_documents(no_docs, model).count() == 0
    kept = toxicity.drop_toxic(docs.unionByName(hard_docs.select("doc_id", "text", "lang")), model)
    assert kept.where("text LIKE '%grbl%' OR text LIKE '%snork%'").count() <= 3
    assert toxicity.drop_toxic(hard_docs, model).columns == hard_docs.columns


def test_texts_without_labels_are_not_shuffled(spark, monkeypatch):
    docs = spark.range(-10, 4000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(None, "null")], "doc_id LONG, text STRING"))
    labels = spark.range(0, 3000, 3).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    likely = toxicity.likely_in(docs, labels, "doc_id")
    assert likely.columns == docs.columns
    assert likely.join(labels, "doc_id").count() == 1000 and likely.count() < 1050
    assert toxicity.likely_in(docs, labels, "doc_id", bits=8).join(labels, "doc_id").count() == 1000
    assert toxicity.likely_in(docs, labels.where("false"), "doc_id").count() == 0
    plans = []
    monkeypatch.setattr(toxicity, "stage", lambda df, name: plans.append(plan(df)) or df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        toxicity.labelled_texts(docs, labels)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plans[0] and plans[0].index("BroadcastHashJoin") > plans[0].index("SortMergeJoin")


def test_toxicity_learns_from_every_labelled_document(spark, monkeypatch):
    rng = random.Random(5)
    # Long texts, and more documents than one task fits.
    made = [(k, " ".join(rng.choice(WORDS) for _ in range(2_000 if k % 40 < 2 else 20)) + (" grbl" if k % 2 else ""), k % 2) for k in range(700)]
    docs = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    usable = {r.doc_id for r in labels.where(toxicity.may_learn(F.col("doc_id"))).collect()}
    assert {r.doc_id for r in toxicity.labelled_texts(docs.drop("toxic"), labels).collect()} == usable
    monkeypatch.setattr(toxicity, "ALONE", 200)
    monkeypatch.setattr(toxicity, "CELL", 50)
    models = [toxicity.fit_model(some.drop("toxic"), labels) for some in (docs.repartition(3), docs.repartition(5))]
    # The layout of the rows changes nothing.
    assert (models[0].network.embedding == models[1].network.embedding).all() and models[0].thresholds == models[1].thresholds
    held = [(text, toxic) for k, text, toxic in made if k not in usable]
    scores = models[0].network.scores([text for text, _ in held])
    assert np.mean((scores >= 0.5) == np.array([toxic for _, toxic in held])) > 0.95


def test_thresholds_are_by_exact_places(spark):
    net = toxicity.TextCnn.new()
    texts = [words(30, k) for k in range(300)]
    held = spark.createDataFrame([(t, "en", int(k % 3 == 0)) for k, t in enumerate(texts)], "text string, lang string, toxic int")
    scores, toxic = net.scores(texts), np.arange(300) % 3 == 0
    limit, low = np.sort(scores[~toxic])[::-1][int(0.05 * 200)], np.quantile(scores[toxic], 0.05)
    got = toxicity.thresholds_of(net, held, 0.05)
    assert set(got) == {None, "en"} and all(abs(x - toxicity.calibrate(limit, low, 200)) < 1e-12 for x in got.values())


def test_toxicity_without_labels(spark, hard_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit_model(hard_docs, none)
    assert toxicity.drop_toxic(hard_docs, model).count() == hard_docs.count()


def test_fast_scores_are_the_network_s():
    net = toxicity.TextCnn.new(buckets=64)
    text = words(50, 3)
    rows_ = np.array([net.embedding[toxicity.features_of(w, 64)].sum(0) for w in toxicity.words_of(text)])
    pooled = []
    for f, b in zip(net.filters, net.biases):
        m = len(rows_) - len(f) + 1
        pooled.append(np.maximum(max(sum(rows_[p + k] @ f[k] for k in range(len(f))).tolist() for p in range(m)) if False else
                                 np.max([sum(rows_[p + k] @ f[k] for k in range(len(f))) for p in range(m)], axis=0) + b, 0))
    want = 1 / (1 + np.exp(-(np.concatenate(pooled) @ net.out + net.bias)))
    assert net.scores([text])[0] == pytest.approx(want, abs=1e-5)


# Secrets


def test_secrets_are_told_from_what_looks_like_them(spark, hard_docs, no_docs):
    secret = hashlib.sha1(b"x").hexdigest()
    texts = {
        101: f'left token = "{secret}" right', 102: f"see commit {secret} there", 103: "number 1234567812345678 end", 104: f'a TOKEN = "{secret.upper()}"!! b 4444333322221111',
        105: "section-and-part-12 of it", 106: f'twice token = "{secret}" and token = "{secret[::-1]}"',
    }
    docs = spark.createDataFrame([(i, t, "src", len(t)) for i, t in texts.items()], "doc_id long, text string, source string, n_chars long")
    docs = docs.unionByName(hard_docs.select("doc_id", "text", "source", "n_chars"))
    found = secret_scan.scan(docs).collect()
    for r in found:
        if r.doc_id in texts:
            value = texts[r.doc_id][r.start : r.start + r.length]
            assert hashlib.sha256(value.encode()).hexdigest() == r.value_sha256
    assert sorted((r.doc_id, r.number) for r in found if r.is_secret and len(texts.get(r.doc_id, "")) > 20) == [(101, 0), (104, 0), (106, 0), (106, 1)]
    masked = {r.doc_id: r for r in secret_scan.mask_secrets(docs.where("doc_id > 100")).collect()}
    assert masked[101].text == 'left token = "[secret]" right' and masked[101].n_chars == len(masked[101].text)
    assert masked[102].text == texts[102] and masked[104].text == 'a TOKEN = "[secret]"!! b 4444333322221111'
    assert masked[106].text.count("[secret]") == 2
    whole = secret_scan.mask_secrets(hard_docs)
    assert whole.columns == hard_docs.columns and whole.count() == hard_docs.count()
    assert secret_scan.scan(no_docs).count() == 0


def test_unquoted_known_and_symbol_secrets_are_masked(spark):
    hexed = hashlib.sha256(b"y").hexdigest()
    values = {
        "password={}": "Xk3f9QmZ81LpTr20", "x AWS_SECRET_ACCESS_KEY={}": "wJalrXUtnFEMIK7MDENGbPxRfiCYzQ83kLmWp2Tv", "S3_ACCESS_KEY={}": "Qm9vYmFyQmF6MTIzNDU2Nzg5Zz09", "see https://h.example/p?token={}&page": hexed[:32],
        "we found {} in it": "AKIA" + hexed[:16].upper(), "then {} is here": "ghp_" + (hexed * 2)[7:43], "password: {} ok": "tR@9x.Lq!7$w", "PASSWORD={}": "a$K9!z", "db_password={}": "QzXkVwJpGyabTr",
    }
    plain = ["see commit " + hexed[:40], "section-and-part-12 of it", "the password: required and", "call 2024-01-01T001234567"]
    texts = [k.format(v) for k, v in values.items()] + plain
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    masked = [r.text for r in secret_scan.mask_secrets(docs).orderBy("doc_id").collect()]
    assert masked == [k.format("[secret]") for k in values] + plain
    found = docs.select(F.inline(secret_scan.candidates(F.col("text"))), "doc_id").where(f"doc_id < {len(values)}").collect()
    assert set(values.values()) <= {r.value for r in found}
    assert all(r.value == texts[r.doc_id][r.start : r.start + len(r.value)] for r in found)
    # What is merely not assigned gets no label.
    loose = spark.createDataFrame([("", hexed[:24], "with ", " in it"), ("", "AKIA" + hexed[:16].upper(), "with ", " in it")], "path string, value string, before string, after string")
    assert [r.label for r in secret_scan.rule_labels(loose).collect()] == [1]


# Surrogates


ENTITY_TEXT = (
    "call +1 (017) 555-7713 or +1-017-555-7713, a.b34@mail7.example.com A.B34@mail7.example.com 97.51.17.173 9807915762804490 "
    "9807 9157 6280 4490 Mr. John Smith and Mrs. Maria Lopez, Frau Müller; DE89 3704 0044 0532 0130 00 госпожа Иванова 123-45-6789"
)


def test_surrogates_keep_type_format_and_identity(spark, hard_docs, no_docs):
    docs = spark.createDataFrame([(1, ENTITY_TEXT), (2, "again 97.51.17.173 and Mr. John Smith"), (None, "x " + ENTITY_TEXT)], "doc_id long, text string")
    found = surrogates.mentions(docs).collect()
    assert {r.type for r in found} == set(surrogates.PATTERNS)
    by = {}
    for r in found:
        assert r.value != r.surrogate and len(r.value) == len(r.surrogate) or r.type == "ip"
        shape = lambda s: re.sub("[a-zà-ÿа-я]", "a", re.sub("[A-ZÀ-ßА-Я]", "A", re.sub("[0-9]", "0", s)))
        assert r.type == "ip" or shape(r.value) == shape(r.surrogate)
        assert by.setdefault((r.type, r.canonical), re.sub("[^A-Za-z0-9]", "", r.surrogate).lower()) == re.sub("[^A-Za-z0-9]", "", r.surrogate).lower()
    assert {(r.gender, r.script) for r in found if r.type == "name"} == {("male", "latin"), ("female", "latin"), ("female", "cyrillic")}
    new = surrogates.replace_entities(docs).collect()
    text = next(r.text for r in new if r.doc_id == 1)
    assert not any(r.value in text for r in found if r.type != "name" or len(r.value) > 4)
    assert surrogates.replace_entities(hard_docs).columns == hard_docs.columns
    assert rows(surrogates.replace_entities(hard_docs).select("doc_id", "text")) == rows(hard_docs.select("doc_id", "text"))
    assert surrogates.entity_report(no_docs).count() == 0


def test_permutation_has_no_collisions(spark):
    df = spark.range(3000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("v"))
    new = df.select(surrogates.permuted(F.split("v", ""), F.lit("key")).alias("n"))
    assert new.distinct().count() == 3000 and new.where("n RLIKE '^[0-9]{4}$'").count() == 3000
    ips = spark.range(3000).select(F.concat(F.lit("10.0."), (F.col("id") / 256).cast("int"), F.lit("."), F.col("id") % 256).alias("v"))
    assert ips.select(surrogates.surrogate(F.lit("ip"), F.col("v"), "0")).distinct().count() == 3000


def test_collisions_are_found(spark):
    same = spark.createDataFrame([("card", "1", "7"), ("card", "2", "7"), ("email", "a", "x"), ("email", "a", "y")], "type string, canonical string, surrogate string")
    assert sorted(r.type for r in surrogates.collisions(same).collect()) == ["card", "email"]


def test_mentions_of_one_entity_agree_and_no_others_meet(spark):
    same = "+44 20 7946 0958, +4420 7946 0958, +44 (20) 7946 0958; 1.2.03.4 and 1.2.3.4;"
    others = "44 20 7946 0958, +1 415 555 0123; 300.2.3.4, 300.2.03.4, 999.999.999.999, 1.2.3.5;"
    docs = spark.createDataFrame([(1, same), (2, others)], "doc_id long, text string")
    assert surrogates.checked_version(docs) == "0"
    found = surrogates.mentions(docs).collect()
    new = {(r.type, r.value): r.surrogate for r in found}
    digits = lambda s: re.sub("[^0-9+]", "", s)
    assert len({digits(new["phone", v]) for v in ("+44 20 7946 0958", "+4420 7946 0958", "+44 (20) 7946 0958")}) == 1
    assert new["phone", "+4420 7946 0958"].startswith("+44") and new["phone", "+1 415 555 0123"].startswith("+1 ")
    assert new["ip", "1.2.03.4"] == new["ip", "1.2.3.4"] and len({r.surrogate for r in found if r.type == "ip"}) == 5
    assert surrogates.entity_report(docs).count() == 2


def test_every_entity_changes_and_is_counted(spark):
    names = ["Παπαδόπουλος", "Ωμέγα", "Արամ", "Żółć", "Ёлкин", "Bo", "Ey", "Éa", "Ångström", "Nguyễn"]
    values = [f"Dr. {n}" for n in names] + ["+14155550123", "0151 23456789", "(0151)23456789", "378282246310005", "3782 822463 10005", "255.255.255.255", "a@b.example"]
    docs = spark.createDataFrame([(k, f"ask {v}, please") for k, v in enumerate(values)], "doc_id long, text string")
    report = {r.doc_id: r for r in surrogates.entity_report(docs).collect()}
    for k, v in enumerate(values):
        assert (report[k].n_entities, report[k].n_changed) == (1, 1), v
        assert report[k].text != f"ask {v}, please"
    two = spark.createDataFrame([(a + b,) for a in "BCDFGHJKLMNPQRSTVWXYZ" for b in "ao"], "v string")
    new = two.select("v", surrogates.surrogate(F.lit("name"), F.col("v"), "0").alias("n")).collect()
    assert len({r.n for r in new}) == len(new) and all(r.n != r.v for r in new)


# Sketches


def paragraphs(text):
    return {p for p in re.split(r"\n+|(?<=[.!?]) +", text) if p}


def test_sketches(spark, hard_docs, no_docs):
    many = [(100 + k, ". ".join(words(3, s) for s in range(k * 7, k * 7 + k * 9)) + ".") for k in range(1, 9)]
    docs = [tuple(r) for r in hard_docs.select("doc_id", "text").collect()] + many
    got = paragraph_sketch.compare_with_edits(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    ordered = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (i, t) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(alike(paragraphs(t), paragraphs(edited)), 9), round(alike(paragraphs(t), paragraphs(after)), 9)))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got), key=repr) == sorted(want, key=repr)
    prints = {}
    for r, (i, t) in zip(sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0)), ordered):
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    assert paragraph_sketch.compare_with_edits(no_docs).count() == 0


@pytest.mark.parametrize(
    "sentence, gap",
    [("word {} of a line.", " "), ("Zebra {} runs!", " "), ("Слово {} в строке.", " "), ("هل هذا {} سطر؟", " "), ("यह {} पंक्ति है।", " "), ("这是第{}句话。", "")],
)
def test_one_line_texts_are_cut_at_sentence_ends_of_every_script(spark, sentence, gap):
    texts = [gap.join(sentence.format(100 * d + k) for k in range(100, 140)) for d in (1, 2)]
    got = paragraph_sketch.compare_with_edits(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    # Thirty of forty sentences stay, ten or eleven new ones come.
    assert all(0.55 < r.near_edited < 0.65 and r.near_next == 0 for r in got)


def test_next_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(paragraph_sketch, "RANGE_ROWS", 7)
    docs = spark.createDataFrame([(i * 3 % 101, f"t{i * 3 % 101}") for i in range(100)] + [(None, "none"), (5, "t5")], "doc_id long, text string")
    ordered = sorted(([r.doc_id, r.text] for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = sorted(((i, t, ordered[(k + 1) % len(ordered)][1]) for k, (i, t) in enumerate(ordered)), key=repr)
    assert rows(paragraph_sketch.with_next(docs)) == want


@pytest.mark.parametrize("n, m", [(0, 0), (0, 9), (3, 3), (30, 25), (400, 390)])
def test_peeling_recovers_the_differences(spark, n, m):
    a = [xxhash.xxh64_intdigest(f"a{k}") >> 1 for k in range(n)]
    b = [xxhash.xxh64_intdigest(f"a{k}") >> 1 for k in range(n // 2)] + [xxhash.xxh64_intdigest(f"b{k}") >> 1 for k in range(m)]
    df = spark.createDataFrame([(a, b)], "a array<bigint>, b array<bigint>")
    got = df.select(paragraph_sketch.differences(F.col("a"), F.col("b")).alias("d"), paragraph_sketch.recovered(F.col("a"), F.col("b")).alias("r")).first()
    assert (got.d.a, got.d.b) == (len(set(a) - set(b)), len(set(b) - set(a)))
    if not got.r.open:
        assert set(got.r.left) == set(a) - set(b) and set(got.r.right) == set(b) - set(a)


@pytest.mark.parametrize("n, m, shared", [(3, 2, 5), (60, 50, 300), (400, 0, 10)])
def test_the_first_sketch_tried_mostly_peels(spark, n, m, shared):
    made = lambda name, size: [xxhash.xxh64_intdigest(f"{name}{k}") >> 1 for k in range(size)]
    sets = [(made(f"a{i}_", n) + made(f"s{i}_", shared), made(f"b{i}_", m) + made(f"s{i}_", shared)) for i in range(40)]
    df = spark.createDataFrame(sets, "a array<bigint>, b array<bigint>").select(paragraph_sketch.sketched(F.col("a")).alias("a"), paragraph_sketch.sketched(F.col("b")).alias("b"))
    left = paragraph_sketch._subtracted(F.col("a.cells"), F.col("b.cells"))
    levels = df.select("a", "b", paragraph_sketch._likely_level(left, F.size("a.keys"), F.size("b.keys")).alias("level"))
    marked = F.concat(F.col("a.marks"), paragraph_sketch._minus(F.col("b.marks")))
    got = levels.select("level", paragraph_sketch._subtract(marked, F.col("level")).alias("d")).collect()
    peeled = [r for r in got if r.d]
    assert all((r.d.a, r.d.b) == (n, m) for r in peeled) and len(peeled) > 20
    # No more sketches than one for every four differences.
    assert all(2**r.level <= max(1, (n + m) / 4) for r in got)


def test_cuts_are_those_of_the_plain_pattern(spark):
    texts = ["a. b.  c.\n\nd。e！ f。。g\nh", "。", "x。\n y", " a.", "a.  ", "é؟ b।  c", "no end", "", "a.\n b", "甲。乙。 丙｡", ". .  ."]
    plain = r"\n+|(?<=[.!?؟۔։।॥።]) +|(?<=[。！？｡])(?![。！？｡ ])|(?<=[。！？｡]) +"
    want = F.array_distinct(F.transform(F.filter(F.split("t", plain), lambda p: p != ""), lambda p: F.xxhash64(p)))
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(paragraph_sketch.digests(F.col("t")).alias("got"), want.alias("want")).collect()
    assert all(r.got == r.want for r in got)


def test_native_operators_have_no_python_nodes(spark, hard_docs):
    from conftest import plan

    for df in (secret_scan.scan(hard_docs), surrogates.replace_entities(hard_docs), paragraph_sketch.compare_with_edits(hard_docs)):
        assert not re.search("Python|Pandas|Arrow", plan(df))


def test_let_computes_once(spark):
    assert spark.range(1).select(let(F.lit(2), lambda x: x * x)).first()[0] == 4
