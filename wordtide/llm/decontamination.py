"""Benchmark decontamination with suffix arrays of the training documents.

Every task turns its documents, a few megabytes at a time, into a shard: one array of word numbers in which documents
are kept apart. The shard's suffix array has, in sorted order, the positions whose suffixes can match a test suffix at
all: those that start with a word pair of the test items, or with the last word of one. Every test suffix is found in it
by binary search. The interval it meets holds the locations of all matches of its first words, and the neighbours in
full order give the longest verbatim match.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.llm.common import map_frames, whole

WINDOW = 10
# Characters of the documents in one shard, and bytes of test text that may be sent to all tasks at once.
SHARD_CHARS = 4_000_000
ITEM_BYTES = 16 << 20

_word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8; lower-casing bytes changes A-Z alone."""
    return _word.findall(text.encode().lower()) if text else []


@dataclass
class TestItems:
    """Test items as word numbers from 1 on; 0 is a word that no item has. Items without words are left out."""

    ids: list
    number: dict[bytes, int]
    words: list[np.ndarray]
    window: int

    @classmethod
    def of(cls, rows: list[tuple], window: int) -> TestItems:
        number: dict[bytes, int] = {}
        kept = [(i, w) for i, text in rows if (w := words_of(text))]
        words = [np.array([number.setdefault(x, len(number) + 1) for x in w], "i8") for _, w in kept]
        return cls([i for i, _ in kept], number, words, window)

    def __post_init__(self):
        # All suffixes, by item and start, with their first words, padded by -1.
        self.item = np.repeat(np.arange(len(self.words)), [len(w) for w in self.words])
        self.start = np.concatenate([np.arange(len(w)) for w in self.words] or [np.zeros(0, "i8")]).astype("i8")
        self.length = np.array([len(self.words[i]) - s for i, s in zip(self.item, self.start)], "i8")
        heads = np.full((len(self.item), self.window), -1, "i8")
        for row, (i, s) in enumerate(zip(self.item, self.start)):
            head = self.words[i][s : s + self.window]
            heads[row, : len(head)] = head
        # Equal heads are searched once.
        self.heads, self.head_of = np.unique(heads, axis=0, return_inverse=True)
        self.head_of = self.head_of.reshape(-1)
        self.head_length = (self.heads >= 0).sum(1)
        # A window is a suffix's first words: ten, or a whole item of fewer.
        sizes = np.array([len(w) for w in self.words], "i8")[self.item] if len(self.item) else np.zeros(0, "i8")
        is_window = (self.length >= self.window) | ((self.start == 0) & (sizes < self.window))
        self.windows = np.unique(self.head_of[is_window])
        self.items_of: dict[int, set[int]] = {}
        for h, i in zip(self.head_of[is_window].tolist(), self.item[is_window].tolist()):
            self.items_of.setdefault(h, set()).add(i)
        pairs = {(int(a), int(b)) for w in self.words for a, b in zip(w, w[1:])}
        self.pairs = np.sort(np.array([a * (len(self.number) + 2) + b for a, b in pairs], "i8"))
        self.last = np.zeros(len(self.number) + 1, bool)
        self.last[[int(w[-1]) for w in self.words]] = True
        self.deepest = max((len(w) for w in self.words), default=0)


@dataclass
class Shard:
    """Word numbers of some documents, each followed by an end mark of -1, and their sparse suffix array."""

    text: np.ndarray
    first: np.ndarray
    positions: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, texts: list[str], items: TestItems) -> Shard:
        get, parts, first, at = items.number.get, [], [], 0
        for text in texts:
            words = words_of(text)
            first.append(at)
            parts.append(np.fromiter((get(w, 0) for w in words), "i8", len(words)))
            parts.append(np.array([-1]))
            at += len(words) + 1
        flat = np.concatenate(parts) if parts else np.zeros(0, "i8")
        # Room to read a head at the last position.
        text = np.concatenate((flat, np.full(items.window, -1)))
        now, after = text[: len(flat)], text[1 : len(flat) + 1]
        pair = now * (len(items.number) + 2) + np.maximum(after, 0)
        place = np.searchsorted(items.pairs, pair)
        possible = (now > 0) & (after > 0) & (np.append(items.pairs, -1)[place] == pair)
        possible |= (now > 0) & items.last[np.maximum(now, 0)]
        positions = np.flatnonzero(possible)
        keys = as_keys(heads_at(text, positions, items.window))
        order = np.argsort(keys, kind="stable")
        return cls(text, np.array(first, "i8"), positions[order], keys[order])


def heads_at(text: np.ndarray, positions: np.ndarray, window: int) -> np.ndarray:
    """The first words of the suffixes; nothing of the next document is read over an end mark."""
    heads = text[positions[:, None] + np.arange(window)]
    ended = np.logical_or.accumulate(heads < 0, axis=1)
    heads[ended] = -1
    return heads


def as_keys(heads: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort the same way; an end sorts first."""
    data = np.ascontiguousarray((heads + 1).astype(">u4"))
    return data.view(f"S{4 * heads.shape[1]}").reshape(-1)


def intervals(shard: Shard, items: TestItems) -> tuple[np.ndarray, np.ndarray]:
    """Of every distinct head the interval of the suffix array that starts with it.

    A head shorter than the window meets every suffix that starts with its words, so its upper end is searched for with
    the highest value in place of what follows.
    """
    low = np.searchsorted(shard.keys, as_keys(items.heads), "left")
    top = np.where(items.heads < 0, 0xFFFFFFFE, items.heads)
    high = np.searchsorted(shard.keys, as_keys(top), "right")
    return low, high


def hits(shard: Shard, items: TestItems) -> tuple[np.ndarray, list[set[int]]]:
    """Which words of the shard lie inside an occurrence of a window, and the items of each document."""
    covered = np.zeros(len(shard.text) + 1, "i8")
    found: list[set[int]] = [set() for _ in shard.first]
    low, high = intervals(shard, items)
    met = items.windows[low[items.windows] < high[items.windows]]
    for head in met.tolist():
        at = shard.positions[low[head] : high[head]]
        covered[at] += 1
        covered[at + items.head_length[head]] -= 1
        for doc in np.unique(np.searchsorted(shard.first, at, "right") - 1).tolist():
            found[doc] |= items.items_of[head]
    return np.cumsum(covered)[: len(shard.text)] > 0, found


def longest_matches(shard: Shard, items: TestItems, least: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(item, its start, length, document, its start, number of locations) of every test suffix's longest match.

    Only suffixes that meet their whole head, or are shorter than the window, can match ``least`` words or more; the
    positions of their interval are put in full order, and the longest match is next to where the suffix belongs.
    """
    low, high = intervals(shard, items)
    by_head: dict[int, list[int]] = {}
    for suffix, head in enumerate(items.head_of.tolist()):
        if low[head] < high[head] and items.length[suffix] >= least:
            by_head.setdefault(head, []).append(suffix)
    for head, suffixes in by_head.items():
        at = shard.positions[low[head] : high[head]]
        tails = {}
        for p in at.tolist():
            some = shard.text[p : p + items.deepest]
            end = np.flatnonzero(some < 0)
            tails.setdefault((some[: end[0]] if len(end) else some).astype(">u4").tobytes(), []).append(p)
        ordered = sorted(tails)
        for suffix in suffixes:
            i, s = int(items.item[suffix]), int(items.start[suffix])
            query = items.words[i][s:].astype(">u4").tobytes()
            place = bisect_left(ordered, query)
            best = max((shared(query, ordered[k]) for k in (place - 1, place) if 0 <= k < len(ordered)), default=0)
            if best >= least:
                begin = query[: 4 * best]
                k = bisect_left(ordered, begin)
                n, p = 0, tails[ordered[k]][0]
                while k < len(ordered) and ordered[k].startswith(begin):
                    n, k = n + len(tails[ordered[k]]), k + 1
                doc = int(np.searchsorted(shard.first, p, "right")) - 1
                yield i, s, best, doc, p - int(shard.first[doc]), n


def shared(a: bytes, b: bytes) -> int:
    """Words that two byte strings of words start with alike."""
    n = min(len(a), len(b)) // 4
    x, y = np.frombuffer(a, ">u4", n), np.frombuffer(b, ">u4", n)
    other = np.flatnonzero(x != y)
    return int(other[0]) if len(other) else n


def shards(batch: pd.DataFrame, items: TestItems) -> Iterator[tuple[int, int, Shard]]:
    """The batch in portions of ``SHARD_CHARS`` characters or one document: first row, end row and shard."""
    texts = [t if isinstance(t, str) else "" for t in batch["text"]]
    begin, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= SHARD_CHARS or k == len(texts) - 1:
            yield begin, k + 1, Shard.of(texts[begin : k + 1], items)
            begin, held = k + 1, 0


def load_items(benchmark: DataFrame, most_bytes: int = ITEM_BYTES) -> list:
    """Broadcasts of the test items, in portions of at most ``most_bytes`` of text, or one item.

    The size is added up by Spark first. A set beyond one portion makes several passes over the documents, so no task
    ever holds more than one portion, and the driver only hands portions on.
    """
    spark = benchmark.sparkSession
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = -(-total // most_bytes) or 1
    rows = benchmark.select("item_id", "text")
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
    return [
        spark.sparkContext.broadcast([(r[0], r[1]) for r in rows.where(part == k).collect()]) for k in range(slices)
    ]


DIGEST = "doc_id BIGINT, n_words BIGINT, n_hit BIGINT, n_items BIGINT, items_sha256 STRING, contaminated BOOLEAN"


def _digest(sent: list, window: int):
    def rows(batches):
        items = None
        for batch in batches:
            n_words, hit_words, names = np.zeros(len(batch), "i8"), {}, [set() for _ in range(len(batch))]
            for portion in sent:
                if items is None or len(sent) > 1:
                    items = TestItems.of(portion.value, window)
                for begin, _, shard in shards(batch, items):
                    hit, found = hits(shard, items)
                    hit_words[begin] = hit | hit_words.get(begin, False)
                    for k, some in enumerate(found, begin):
                        names[k] |= {str(items.ids[i]) for i in some if items.ids[i] is not None}
                    ends = np.append(shard.first[1:], len(shard.text) - window) - 1
                    n_words[begin : begin + len(ends)] = ends - shard.first
            n_hit = np.zeros(len(batch), "i8")
            for begin, hit in hit_words.items():
                # Word counts say where each document is in the shard; an end mark, never hit, follows each.
                cuts = np.concatenate(([0], np.cumsum(n_words[begin:] + 1)))
                cuts = cuts[cuts < len(hit) - window + 1]
                total = np.concatenate(([0], np.cumsum(hit)))[cuts]
                n_hit[begin : begin + len(cuts) - 1] = np.diff(total)
            joined = [",".join(sorted(some)) for some in names]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_words": n_words,
                    "n_hit": n_hit,
                    "n_items": np.array(list(map(len, names)), "i8"),
                    "items_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in joined],
                    "contaminated": n_hit > 0,
                }
            )

    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document.

    A NULL or empty text has no words and is never hit; an item without words has no windows; items without an id hit
    words but aren't counted. Repeated rows each get a row, a NULL id stays NULL, empty tables are fine on either side.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"))
    return map_frames(texts, _digest(load_items(benchmark), window), DIGEST)


def verbatim_matches(docs: DataFrame, benchmark: DataFrame, least: int = WINDOW, window: int = WINDOW) -> DataFrame:
    """item_id, item_start, n_words, doc_id, doc_start, n_locations: the longest match of every test suffix in every
    shard, with one location (all starts counted in words) and how many places hold it, if it has ``least`` words."""
    out = "item_id STRING, item_start BIGINT, n_words BIGINT, doc_id BIGINT, doc_start BIGINT, n_locations BIGINT"

    def rows_of(items_sent):
        def rows(batches):
            items = TestItems.of(items_sent.value, window)
            for batch in batches:
                docs_of = [None if d is pd.NA else d for d in batch["doc_id"]]
                found = [
                    (None if items.ids[i] is None else str(items.ids[i]), s, n, docs_of[begin + d], p, k)
                    for begin, _, shard in shards(batch, items)
                    for i, s, n, d, p, k in longest_matches(shard, items, least)
                ]
                yield found

        return rows

    texts = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"))
    result = None
    for sent in load_items(benchmark):
        one = map_frames(texts, rows_of(sent), out)
        result = one if result is None else result.unionByName(one)
    return result


def _clean(items_sent, window: int):
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = TestItems.of(items_sent.value, window)
        for texts in batches:
            keep = np.ones(len(texts), bool)
            for begin, _, shard in shards(pd.DataFrame({"text": texts}), items):
                hit, _ = hits(shard, items)
                docs = np.searchsorted(shard.first, np.flatnonzero(hit), "right") - 1
                keep[begin + docs] = False
            yield pd.Series(keep)

    return clean


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with all their columns, that hold no window of any item. Removal is row by row, without shuffle.

    Python sees texts only, so the other columns may be of any type.
    """
    kept = docs
    for sent in load_items(benchmark):
        kept = kept.where(_clean(sent, window)(whole()))
    return kept
