"""Token counts, packing and plane files against the tokenizers library itself."""

import io
import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import rows
from hard_rows import hard_docs, no_docs  # noqa: F401
from tokenizers import Tokenizer

from wordtide.llm.packing import best_fit, cut_documents, pack_documents, pack_lengths, place, plan_of, sequences
from wordtide.llm.token_counts import add_missing, read_cache, token_counts
from wordtide.llm.token_files import BLOCK, PlaneWriter, from_planes, read_chunk, read_documents, read_index, to_planes, token_files
from wordtide.llm.tokens import BYTE_BPE, WORD_BPE, WordEncoder, encoder, tokenizer_digest
from wordtide.session import fresh_path, stage

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def library(name, texts):
    found = Tokenizer.from_file(public_tokenizers.path(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in found]


ODD = [
    "", " ", "  a", "a  ", "a \n b", "\n\n", "a\n  b", "x <|endoftext|> y", "<|endoftext|>", "<|startoftext|>a b", "tab\tand\u00a0no-break  space",
    "it's I'LL  don't", "e\u0301 \u0301 combining", "\x1c sep \x85 next", "日本語 テキスト", "😀 a😀b", "ΑΣ ΟΔΟΣ", "a" * 5000, "12 345 6", "end\u2028line",
]


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_word_wise_ids_are_the_library_s(name):
    random.seed(3)
    pieces = [*ODD, "the", "Of", ",", "ünd", "\t", "\r\n", "<|endoftext|>", "..", "'s", "7"]
    texts = ODD + ["".join(random.choice([" ", "", "\n", "  "]) + random.choice(pieces) for _ in range(12)) for _ in range(600)]
    texts = [t for t in texts if len(t) < 20_000]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder(name).encode(texts)]
    for text, a, b in zip(texts, got, library(name, texts)):
        assert a == b, repr(text)


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_words_of_letters_need_no_marks(name, monkeypatch):
    own, sent = WordEncoder(name), []
    plain = own.plain
    monkeypatch.setattr(own, "plain", lambda texts: sent.extend(texts) or plain(texts))
    random.seed(5)
    letters = "abcdefghßſŉάςΣжñÑéあ漢한Ġłª"
    words = ["".join(random.choices(letters, k=random.randrange(1, 12))) for _ in range(3000)]
    library = Tokenizer.from_file(public_tokenizers.path(name))
    for odd in ([], ["İstanbul", "\u1100\u1161\u11a8", "\u01c5", "𝒳𐐀"]):
        texts = [" ".join(["", *words[:1500], *odd]), " ".join(["", *words[1500:]])]
        want = [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]
        assert list(own.encode(texts)) == want
        if not odd:
            assert not any(own.mark in x for x in sent)


def test_counts(spark, hard_docs, no_docs):
    texts = hard_docs.select("doc_id", "text").collect()
    want = sorted(((r[0], len((r[1] or "").encode()), len(i), len(i) > 512) for r, i in zip(texts, library(BYTE_BPE, [r[1] for r in texts]))), key=repr)
    assert rows(token_counts(hard_docs)) == want
    assert token_counts(no_docs).count() == 0


def test_cache_is_used_and_appended_to(spark, hard_docs):
    cache = fresh_path(spark, "cache")
    version = tokenizer_digest(BYTE_BPE)
    first = spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id long, text string")
    add_missing(first, cache)
    assert spark.read.parquet(cache).count() == 1
    # A known count is taken from the cache as it is.
    spark.read.parquet(cache).withColumn("n_tokens", spark.range(1).selectExpr("99L").scalar()).write.parquet(cache + "-changed")
    more = first.unionByName(spark.createDataFrame([(3, "new one")], "doc_id long, text string"))
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts(more, cache + "-changed").collect()}
    assert got[1] == got[2] == 99 and got[3] == 2
    assert read_cache(more, cache + "-changed", version).count() == 2
    assert read_cache(more, cache, "another version").count() == 0


def check_packing(pieces, room, texts):
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    want = Counter()
    for doc, ids in zip(texts, library(BYTE_BPE, [t[1] for t in texts])):
        ids = np.array([*ids, 0], "<u4")
        first = len(ids) % room or room
        for piece, (a, b) in enumerate(zip([0, *range(first, len(ids), room)], [*range(first, len(ids), room), len(ids)])):
            want[doc[0], piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces) == want
    return len(by_sequence)


def test_packing(hard_docs, no_docs):
    for room in (2048, 16):
        texts = [tuple(r) for r in hard_docs.select("doc_id", "text").collect()]
        kept = pack_documents(hard_docs, room=room, keep_ids=True).collect()
        check_packing(kept, room, texts)
        assert all(zlib.crc32(bytes(p["ids"])) == p["ids_crc32"] for p in kept)
    assert pack_documents(no_docs).count() == 0


def test_packing_of_a_common_length(spark):
    docs = spark.createDataFrame([(i, "same text again") for i in range(500)] + [(1000 + i, "x " * i) for i in range(100)], "doc_id long, text string").repartition(4)
    pieces = stage(cut_documents(docs, room=64), "pieces")
    got = place(pieces, 64).collect()
    n = check_packing(got, 64, [tuple(r) for r in docs.collect()])
    assert n <= -(-sum(p["length"] for p in got) // 64) * 1.05 + 1


def test_words_are_encoded_once_for_all_cases():
    """Ids are the library's where capitals meet marks, special strings and letters that fold in odd ways."""
    texts = ["Word WORD word wOrD", "T\u0308x H\u0331 J\u030c A\u030a I\u0307 \u0130 t\u0308", "<|STARTOFTEXT|> <|endoftext|> <|EndOfText|>", "<|A", "\u212a K \u03a3\u03a3 \u00c9 E\u0301", "A\0B I'LL I'll", "W\u030a.", ""]
    known = WordEncoder(WORD_BPE)
    for text in texts:
        assert [np.frombuffer(x, "<u4").tolist() for x in known.encode([text])] == [list(x) for x in library(WORD_BPE, [text])]
    fresh = WordEncoder(WORD_BPE)
    list(fresh.encode(texts[:1]))
    assert set(fresh.known) == {"word"}


def test_pieces_are_numbered_by_id(spark):
    docs = spark.createDataFrame([(i * 7 % 40, "same text") for i in range(40)] + [(None, "same text")], "doc_id long, text string").repartition(2)
    pieces = cut_documents(docs, room=64).collect()
    for part in {r["part"] for r in pieces}:
        ids = [r["doc_id"] for r in sorted((r for r in pieces if r["part"] == part), key=lambda r: r["nth"])]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_packing_shuffles_no_ids(hard_docs, monkeypatch):
    """Pieces stay where they were written, and are joined by shuffle only if the counts are too many to broadcast."""
    from conftest import plan

    from wordtide.llm import packing

    frame = pack_documents(hard_docs, room=16, keep_ids=True)
    assert "BroadcastHashJoin" in plan(frame) and "SortMergeJoin" not in plan(frame)
    monkeypatch.setattr(packing, "MOST_COUNTS", 0)
    joined = pack_documents(hard_docs, room=16, keep_ids=True)
    columns = ["doc_id", "piece", "start", "ids_crc32"]
    assert rows(joined, *columns) == rows(frame, *columns)
    check_packing(joined.collect(), 16, [tuple(r) for r in hard_docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("seed", range(4))
def test_plan_covers_every_rank_and_packs_tightly(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(4, 1, 3000).astype(int), 1, 256)
    histogram = Counter(lengths.tolist())
    held = Counter()
    for length, of in {n: sorted(r for r in pack_lengths(histogram, 256, 100) if r[0] == n) for n in histogram}.items():
        assert of[0][1] == 0
        for (_, rank, seq, each, _), end in zip(of, [r[1] for r in of[1:]] + [histogram[length]]):
            assert (end - rank) % each == 0
            for s in range(seq, seq + (end - rank) // each):
                held[s] += each * length
    assert max(held.values()) <= 256
    assert len(held) <= -(-int(lengths.sum()) // 256) * 1.01 + 1


# Histograms that greedy filling packs badly, and the fewest sequences that each needs.
HARD_LENGTHS = {
    "copies": ({1100: 1000, 256: 3000}, 1000),
    "six": (dict.fromkeys([400, 600, 800, 1000, 1200, 1400], 1000), 2700),
    "thirds": ({682: 1000, 683: 1000, 684: 1000, 1: 500}, 1125),
    "halves": ({1025: 500, 1023: 700}, 600),
    "quarters": ({520: 4000, 500: 4000, 1016: 1000}, 2500),
    "few": ({2000: 3, 40: 2, 9: 1}, 3),
}


@pytest.mark.parametrize("name", HARD_LENGTHS)
def test_the_program_finds_the_fewest_sequences(name):
    histogram, fewest = HARD_LENGTHS[name]
    plan, bound = plan_of(histogram, 2048, 600)
    held = Counter()
    for configuration, times in plan:
        assert sum(n * each for n, each in configuration.items()) <= 2048
        held.update({n: each * times for n, each in configuration.items()})
    assert held == histogram and bound <= fewest
    assert sequences(plan) == fewest <= sequences(best_fit(histogram, 2048))


@pytest.mark.parametrize("seed", range(3))
def test_plans_are_near_the_bound_and_never_worse_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    for lengths in (rng.lognormal(5.5, 1, 20_000), rng.integers(1, 2048, 5_000), rng.choice([700, 650, 699, 680, 340, 777], 2_000)):
        histogram = dict(Counter(np.clip(lengths, 1, 2047).astype(int).tolist()))
        plan, bound = plan_of(histogram, 2048, 240)
        assert sequences(plan) <= sequences(best_fit(histogram, 2048))
        assert sequences(plan) <= 1.05 * bound + 1


def plain_best_fit(histogram, room):
    spaces = []
    for n in sorted(histogram, reverse=True):
        for _ in range(histogram[n]):
            at = min((s for s in spaces if s >= n), default=None)
            if at is None:
                at = room
            else:
                spaces.remove(at)
            spaces.append(at - n)
    return len(spaces)


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_over_a_histogram_is_best_fit_piece_by_piece(seed):
    rng = np.random.default_rng(seed)
    histogram = dict(Counter(rng.integers(1, 60 if seed % 2 else 12, 300).tolist()))
    assert sequences(best_fit(histogram, 64)) == plain_best_fit(histogram, 64)


def test_planes():
    rng = np.random.default_rng(1)
    for ids in ([], [0], [1, 2, 3], rng.integers(0, 49_408, 1000), rng.integers(0, 2**32, 77)):
        ids = np.array(ids, "<u4")
        assert (from_planes(to_planes(ids), len(ids)) == ids).all()
    file = io.BytesIO()
    writer, docs = PlaneWriter(file), []
    for doc in (5, None, 7, 8):
        docs.append((doc, rng.integers(0, 60_000, int(rng.integers(0, 2 * BLOCK))).astype("<u4")))
        writer.add(*docs[-1])
    writer.close()
    file.size = lambda: file.getbuffer().nbytes
    flat = np.concatenate([x for _, x in docs])
    for got, want in zip(read_documents(file), docs):
        assert got[0] == want[0] and (got[2] == want[1]).all()
    chunk = read_index(file)["chunks"][1]
    assert (read_chunk(file, chunk) == flat[BLOCK : 2 * BLOCK]).all()


def test_token_files(hard_docs, no_docs):
    texts = sorted(((r[0], r[1] or "") for r in hard_docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r))
    want, start = [], 0
    for (doc, _), ids in zip(texts, library(WORD_BPE, [t for _, t in texts])):
        ids = np.array([*ids, 1], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(rows(token_files(hard_docs)), key=lambda r: r[1]) == want
    assert token_files(no_docs).count() == 0
