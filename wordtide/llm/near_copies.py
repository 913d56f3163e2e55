"""Near copies of texts: five-word shingles, similarity 0.8 and more, found by wide BK-trees and confirmed exactly.

Texts whose sets of shingles have a Jaccard similarity of 0.8 differ in about ten of 64 fingerprint bits, so many bits
that blocks of the fingerprint can't route them. Here fingerprints are routed by ten digests, each of three minima of
the shingles' hashes: texts of similarity 0.8 share one of them with a chance of 0.999, unlike texts hardly ever. Inside
such a bucket BK-trees of bounded shards find the fingerprints within ``RADIUS`` bits. What hangs together by these
candidates is a group of suspects. Every two suspects of a group that are not linked already are then compared by their
whole sets of shingles, unless the distances to a third text rule them out. Links that don't hold are no links, so
unlike texts that share a fingerprint stay apart. Texts with equal sets are one node from the start. Sets are larger than
their texts, so only those of suspects are made a second time and written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm.common import by_batch, free_name, likely, likely_in, map_frames, stage, whole
from wordtide.llm.simhash import SHARD, Forest, components, shard_links

WORDS = 5
ALIKE = 0.8
SEED = 42
BANDS, MINIMA = 10, 3
# 3.6 standard deviations above the bits that differ at a similarity of 0.8.
RADIUS = 20
# Texts and shingles of one shard of suspects.
SUSPECTS, SUSPECT_SHINGLES = 512, 1_000_000
# Odd multipliers order the hashes anew for each minimum.
_ORDERS = np.random.default_rng(SEED).integers(0, 2**63, (2, BANDS * MINIMA), "u8")
_ORDERS[1] |= 1


def shingle_set(text: str, n: int = WORDS) -> np.ndarray:
    """Hashes of the different ``n``-word shingles, ascending; A-Z is lower-cased, words end at ASCII white space.

    Fewer words than ``n`` are one shingle; without words the set is empty.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, "u8")
    shingles = zip(*(islice(words, i, None) for i in range(n))) if len(words) > n else [words]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in shingles), "u8"))


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of a set, as a signed number: a bit is set if over half of the hashes have it."""
    counts = np.zeros(64, "i8")
    for i in range(0, len(hashes), 1 << 14):
        counts += np.unpackbits(hashes[i : i + (1 << 14)].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("i8")[0])


def bands(hashes: np.ndarray) -> list[int]:
    """The buckets of a set: digests of ``MINIMA`` minima each. An empty set has none."""
    if not len(hashes):
        return []
    least = np.full(BANDS * MINIMA, np.iinfo("u8").max, "u8")
    for i in range(0, len(hashes), 4_096):
        least = np.minimum(least, ((hashes[i : i + 4_096, None] ^ _ORDERS[0]) * _ORDERS[1]).min(0))
    return [xxhash.xxh64_intdigest(three.tobytes(), k) - (1 << 63) for k, three in enumerate(least.reshape(BANDS, MINIMA))]


def _name(data: bytes) -> str:
    return xxhash.xxh128_hexdigest(data)


def _shingled(batch: pd.DataFrame) -> list[tuple]:
    """Each different set of a batch once: its name, size and shingles."""
    held = {}
    for text in batch["text"]:
        data = shingle_set(text).astype("<u8").tobytes()
        held[_name(data)] = data
    return [(rep, len(data) // 8, data) for rep, data in held.items()]


def _described(batch: pd.DataFrame) -> list[tuple]:
    rows, seen = [], set()
    for doc, digest, text in zip(batch["doc_id"].tolist(), batch["digest"].tolist(), batch["text"]):
        found = shingle_set(text)
        rep = _name(found.astype("<u8").tobytes())
        # A batch gives an equal set once, so that copies don't multiply it.
        first = rep not in seen
        seen.add(rep)
        one = (rep, majority(found), bands(found)) if first else (rep, None, None)
        rows.append((None if doc is pd.NA else doc, digest, *one))
    return rows


def described(docs: DataFrame) -> DataFrame:
    """doc_id, ``digest`` (a hash of the text), ``rep`` (names the set of shingles) and what describes the set: ``fp`` and
    ``bands``, which some rows of equal sets leave to others. A NULL text is empty."""
    texts = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text")).withColumn("digest", F.xxhash64("text"))
    return map_frames(texts, by_batch(_described), "doc_id BIGINT, digest BIGINT, rep STRING, fp BIGINT, bands ARRAY<BIGINT>")


def meetings(rows: DataFrame, key: str, shards: DataFrame, *columns: str) -> DataFrame:
    """``rows`` copied and sorted so that any two shards of a key meet once, and each shard with itself.

    ``shards`` holds the keys that count and into how many shards their rows are dealt by the hash of ``rep``; it is a
    written table, so that Spark may split a frequent key in the join. Rows of one meeting follow each other, those of
    the lower shard (side 0) first.
    """
    own = F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("shards") - 1),
        lambda other: F.struct(F.least("own", other).alias("low"), F.greatest("own", other).alias("high"), (F.col("own") > other).cast("int").alias("side")),
    )
    met = rows.join(shards.select(key, "shards"), key).withColumn("own", own).select(key, "rep", *columns, F.inline(pairs))
    return met.repartition(key, "low", "high").sortWithinPartitions(key, "low", "high", "side", "rep")


def _linked(key: str, column: str, links: Callable[[list, int], Iterator[tuple[int, int]]]):
    """Links within sorted meetings, which can go over several batches. ``links`` gets the column's values and how many of
    them are of side 0."""

    def found(at, members: list) -> Iterator[tuple[str, str]]:
        if len(members) > 1:
            low = sum(side == 0 for _, _, side in members)
            for i, j in links([value for _, value, _ in members], low):
                yield members[i][0], members[j][0]

    def run(batches):
        at, members = None, []
        for batch in batches:
            out = []
            names = zip(batch[key].tolist(), batch["low"].tolist(), batch["high"].tolist())
            for name, *member in zip(names, batch["rep"].tolist(), batch[column].tolist(), batch["side"].tolist()):
                if name != at:
                    out += found(at, members)
                    at, members = name, []
                members.append(member)
            yield out
        yield list(found(at, members))

    return run


def _near(radius: int):
    def links(fps: list, low: int) -> Iterator[tuple[int, int]]:
        values = np.array(fps, "i8").view("u8")
        return shard_links(values[:low], values[low:], radius)

    return links


def _alike(least: float):
    def links(sets: list, low: int) -> Iterator[tuple[int, int]]:
        return alike_links([np.frombuffer(s, "<u8") for s in sets], least)

    return links


def alike_links(sets: list[np.ndarray], least: float = ALIKE) -> Iterator[tuple[int, int]]:
    """Links that connect the sets whose similarities of ``least`` and more connect them, one fewer than each has members.

    A set is compared with all others at once, as long as one of another connected set could be near: the distance, one
    less the similarity, is a metric, so a set whose distances to an earlier one differ too much can't be.
    """
    total = len(sets)
    sizes = np.array([len(s) for s in sets], "i8")
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    forest = Forest(total)
    root = np.arange(total)
    # Distances from the sets compared last, which rule others out.
    known: list[np.ndarray] = []
    mark = np.zeros(len(codes) + 1, "i4")
    for i in range(total):
        open_ = root != root[i]
        open_[:i] = False
        # Similar sets have similar sizes.
        open_ &= np.minimum(sizes, sizes[i]) >= least * np.maximum(sizes, sizes[i]) - 1e-9
        for far in known:
            open_ &= np.abs(far - far[i]) <= 1 - least + 1e-9
        if not open_.any():
            continue
        mine = codes[starts[i] : ends[i]]
        mark[mine] = 1
        shared = np.add.reduceat(mark[codes], starts)
        mark[mine] = 0
        like = shared / (sizes + sizes[i] - shared)
        known = [*known[-7:], 1 - like]
        # Whole numbers decide, so that exactly ``least`` counts.
        near = np.flatnonzero(shared * (1 + least) >= least * (sizes + sizes[i]) - 1e-9)
        for j in near.tolist():
            forest.join(i, j)
        root = np.array([forest.root(k) for k in range(total)])
    for k, r in enumerate(root.tolist()):
        if r != k:
            yield r, k


def _shards(*bounds: tuple[Column, int]) -> Column:
    return F.greatest(F.lit(1), *[F.ceil(amount / bound).cast("int") for amount, bound in bounds]).alias("shards")


def suspects(sets: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(id, component): sets that BK-trees in shared buckets connect, with the smallest name that they can reach."""
    routed = sets.select("rep", "fp", F.explode("bands").alias("bucket"))
    n = F.count("*")
    sizes = stage(routed.groupBy("bucket").agg(n.alias("n"), _shards((n, shard))).where("n > 1"), "bucket-shards")
    met = meetings(routed, "bucket", sizes, "fp").select("bucket", "rep", "fp", "low", "high", "side")
    links = map_frames(met, _linked("bucket", "fp", _near(radius)), "a STRING, b STRING").distinct()
    found = stage(components(links, "suspect-links"), "suspect-groups")
    # The smallest of a group names it and has no row of its own.
    return found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())


def confirmed(docs: DataFrame, described_: DataFrame, groups: DataFrame, least: float = ALIKE) -> DataFrame:
    """(a, b) links between sets of one group of suspects with a similarity of ``least`` or more.

    One text of each suspected set is read again, with those that the map of digests takes for such; the join drops these.
    """
    named = groups.withColumnRenamed("id", "rep")
    wanted = described_.select("rep", "digest").join(named, "rep").groupBy("rep").agg(F.min("digest").alias("digest"))
    texts = docs.select(whole().alias("text")).withColumn("digest", F.xxhash64("text"))
    sets = map_frames(likely_in(texts, wanted, "digest").select("text"), by_batch(_shingled), "rep STRING, n INT, shingles BINARY")
    held = sets.join(named, "rep")
    once = stage(held.groupBy("component", "rep").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles")), "suspects")
    shards = once.groupBy("component").agg(_shards((F.count("*"), SUSPECTS), (F.sum("n"), SUSPECT_SHINGLES)))
    met = meetings(once, "component", stage(shards, "suspect-shards"), "shingles")
    return map_frames(met.select("component", "rep", "shingles", "low", "high", "side"), _linked("component", "shingles", _alike(least)), "a STRING, b STRING").distinct()


def near_copies(docs: DataFrame, least: float = ALIKE) -> DataFrame:
    """doc_id, ``digest`` (a hash of the text) and ``component``, which names the group of similar texts, of every row.

    A NULL text counts as empty; texts without words are copies of one another. Texts of fewer than five words are
    similar only if their words are equal. Rows that repeat an id, or have none, each get a row, and link nothing by their
    id. An empty table gives no rows. Other columns are not read.
    """
    rows, groups = _grouped(docs, least)
    return rows.join(groups, "rep").select("doc_id", "digest", "component")


def _grouped(docs: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    rows = stage(described(docs), "described")
    full = rows.where("fp IS NOT NULL").select("rep", "fp", "bands")
    sets = stage(full.groupBy("rep").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands")), "sets")
    links = confirmed(docs, rows, suspects(sets), least)
    found = components(links, "confirmed-links").withColumnRenamed("id", "rep")
    groups = sets.select("rep").join(found, "rep", "left").select("rep", F.coalesce("component", "rep").alias("component"))
    return rows.select("doc_id", "digest", "rep"), stage(groups, "copy-groups")


def one_of_near_copies(docs: DataFrame, least: float = ALIKE) -> DataFrame:
    """One document of each group of similar texts, with all its columns: the one with the smallest id.

    Rows of one id with different texts are documents of their own; of those in one group one stays. Rows that are equal
    in id and text are one document. Rows without an id are kept: nothing names them.
    """
    rows, groups = _grouped(docs.select("doc_id", "text"), least)
    # Copies are folded before they meet their group.
    first = rows.where("doc_id IS NOT NULL").groupBy("rep").agg(F.min(F.struct("doc_id", "digest")).alias("first"))
    named = first.join(groups, "rep").groupBy("component").agg(F.min("first").alias("kept"))
    digest, key, open_ = free_name(docs, "digest"), free_name(docs, "key"), free_name(docs, "open")
    named = stage(named.select(F.col("kept.doc_id").alias("doc_id"), F.col("kept.digest").alias(digest)), "kept-copies")
    # Only texts that may go, or may be repeated, are shuffled.
    ids = rows.where("doc_id IS NOT NULL").groupBy("doc_id", F.col("digest").alias(digest)).agg(F.count("*").alias("n"))
    unsure = ids.join(named.withColumn("kept", F.lit(True)), ["doc_id", digest], "left").where("kept IS NULL OR n > 1")
    of_key = F.xxhash64(F.col("doc_id").cast("bigint"), digest)
    told = docs.where("doc_id IS NOT NULL").withColumn(digest, F.xxhash64(whole())).withColumn(key, of_key)
    told = likely(told, unsure.select(of_key.alias(key)), key, open_)
    kept = told.where(open_).join(named, ["doc_id", digest], "left_semi").dropDuplicates(["doc_id", digest])
    return kept.select(*docs.columns).unionByName(told.where(~F.col(open_)).select(*docs.columns)).unionByName(docs.where("doc_id IS NULL"))
