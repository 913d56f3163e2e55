"""Near-duplicates by 64-bit similarity fingerprints and BK-trees.

Fingerprints that differ in at most three bits agree on two of five blocks of bits at least. So each fingerprint is
sent to ten buckets, one for every pair of blocks and their value, and no link is lost. Inside a bucket, fingerprints
are cut into shards of bounded size. A shard becomes a BK-tree: children are keyed by their whole-number Hamming
distance to the parent, and a query follows only the edges within the radius. Each shard tree is sent to the shards of
its own bucket, which are its only possible links, instead of to every task: that keeps the work in proportion.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.llm.common import by_batch, free_name, map_frames, stage, whole

RADIUS = 3
SHINGLE = 3
SEED = 42
# Fingerprints in one shard tree.
SHARD = 4_096
# First bit and width of the blocks.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))

def fingerprint(text: str, n: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is set if it is set in over half of the hashes of the ``n``-word shingles, repeats included.

    Fewer words than ``n`` are one shingle; without words the fingerprint is zero.
    """
    # Bytes are lower-cased in A-Z alone, and split at the six white-space characters of ASCII.
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) > n:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(n))))
    else:
        shingles = [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, seed) for s in shingles], "<u8")
    counts = np.zeros(64, "i8")
    for i in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[i : i + (1 << 16)].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int((np.uint64(1) << np.flatnonzero(2 * counts > len(hashes)).astype("u8")).sum(dtype="u8"))


def _fingerprints(n: int, seed: int):
    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        found = np.array([fingerprint(t, n, seed) for t in batch["text"]], "u8").view("i8")
        return pd.DataFrame({"doc_id": batch["doc_id"], "digest": batch["digest"], "fp": found})

    return by_batch(rows)


def fingerprints(docs: DataFrame, n: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, ``digest`` (a hash of the text) and ``fp``, the fingerprint as a signed number. A NULL text is empty."""
    texts = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"))
    found = texts.withColumn("digest", F.xxhash64("text"))
    return map_frames(found, _fingerprints(n, seed), "doc_id BIGINT, digest BIGINT, fp BIGINT")


class BKTree:
    """A BK-tree over distinct 64-bit fingerprints: the child of a node at distance d holds all below it at distance d."""

    def __init__(self, values: np.ndarray):
        self.values = values
        # For each node its children: distance and node.
        self.children: list[list[tuple[int, int]]] = [[] for _ in values]
        if len(values):
            self._build(np.arange(len(values)))

    def _build(self, members: np.ndarray) -> None:
        """The first member becomes the parent; the rest is split by distance to it."""
        waiting = [members]
        while waiting:
            members = waiting.pop()
            parent, rest = int(members[0]), members[1:]
            if not len(rest):
                continue
            far = np.bitwise_count(self.values[rest] ^ self.values[parent]).astype("i8")
            order = np.argsort(far, kind="stable")
            rest, far = rest[order], far[order]
            cuts = np.flatnonzero(np.diff(far)) + 1
            for below, distance in zip(np.split(rest, cuts), far[np.concatenate(([0], cuts))]):
                self.children[parent].append((int(distance), int(below[0])))
                waiting.append(below)

    def within(self, queries: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, int]]:
        """(positions of queries, node) for every node that has queries within the radius.

        All queries walk together; those that reach a node are split over the edges they may follow.
        """
        if not len(self.values) or not len(queries):
            return
        waiting = [(0, np.arange(len(queries)))]
        while waiting:
            node, at = waiting.pop()
            far = np.bitwise_count(queries[at] ^ self.values[node]).astype("i8")
            if (near := at[far <= radius]).size:
                yield near, node
            for distance, child in self.children[node]:
                if (on := at[np.abs(far - distance) <= radius]).size:
                    waiting.append((child, on))


class Forest:
    """Union-find over positions; the smallest rank of a set is its root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def shard_links(tree_fps: np.ndarray, query_fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect what the tree and the queries connect: one fewer than its members for each connected set."""
    n = len(tree_fps)
    if not n:
        return
    if n + len(query_fps) == 2:
        a, b = (tree_fps[0], tree_fps[1]) if n == 2 else (tree_fps[0], query_fps[0])
        if int(a ^ b).bit_count() <= radius:
            yield 0, 1
        return
    forest = Forest(n + len(query_fps))
    tree = BKTree(tree_fps)
    for near, node in tree.within(query_fps if len(query_fps) else tree_fps, radius):
        for q in near.tolist():
            forest.join(node, q + n if len(query_fps) else q)
    for i in range(len(forest.up)):
        if (r := forest.root(i)) != i:
            yield r, i


def _bucket_links(radius: int):
    """Links inside sorted runs of one bucket and pair of shards. A run, at most two shards, can go over several batches."""

    def links(run: np.ndarray):
        ids, fps, n = run[:, 3], run[:, 4].view("u8"), int((run[:, 5] == 0).sum())
        for i, j in shard_links(fps[:n], fps[n:], radius):
            yield int(ids[i]), int(ids[j])

    def rows(batches):
        kept = np.zeros((0, 6), "i8")
        for batch in batches:
            part = np.concatenate((kept, batch[["bucket", "tree", "query", "rep", "fp", "side"]].to_numpy("i8")))
            if not len(part):
                continue
            cuts = np.concatenate(([0], np.flatnonzero((part[1:, :3] != part[:-1, :3]).any(1)) + 1))
            ends = np.append(cuts[1:], len(part))
            kept = part[cuts[-1] :]
            some = np.flatnonzero((ends - cuts)[:-1] > 1)
            yield _pairs([x for i in some for x in links(part[cuts[i] : ends[i]])])
        if len(kept) > 1:
            yield _pairs(list(links(kept)))

    return rows


def _pairs(found: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame(found, columns=["a", "b"], dtype="i8")


def routed(distinct: DataFrame) -> DataFrame:
    """One row per fingerprint (``rep``, ``fp``) and bucket."""
    buckets = []
    for k, two in enumerate(combinations(BLOCKS, 2)):
        value = F.lit(k).cast("bigint")
        for first, width in two:
            value = F.shiftleft(value, width).bitwiseOR(F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1)))
        buckets.append(value)
    return distinct.select("rep", "fp", F.explode(F.array(*buckets)).alias("bucket"))


def link_pairs(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a, b) links between ``rep`` ids of distinct fingerprints that keep what is connected connected."""
    if not 0 <= radius <= 3:
        raise ValueError("five blocks find radii up to 3")
    rows = routed(distinct)
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    # Written, so that Spark may split a large bucket in the join.
    sizes = stage(sizes, "bucket-sizes")
    shards = F.ceil(F.col("n") / shard).cast("int")
    # Every pair of shards of a bucket meets once: the tree of the lower with the queries of the higher, or a shard
    # with itself. A bucket that fits one shard is not copied.
    own = F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("shards") - 1),
        lambda other: F.struct(F.least("own", other).alias("tree"), F.greatest("own", other).alias("query"), (F.col("own") > other).cast("int").alias("side")),
    )
    met = (
        rows.join(sizes.select("bucket", shards.alias("shards")), "bucket")
        .withColumn("own", own)
        .select("bucket", "rep", "fp", F.inline(pairs))
    )
    return (
        met.repartition("bucket", "tree", "query")
        .sortWithinPartitions("bucket", "tree", "query", "side")
        .mapInPandas(_bucket_links(radius), "a BIGINT, b BIGINT")
        .distinct()
    )


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(id, component) of every linked id: the smallest id it can reach.

    Rounds of large star and small star: neighbours are hung below the smallest one around, until nothing moves. Each
    round is written to the shared folder, which cuts the lineage and outlives executors. Neighbour minima are folded
    before the shuffle, and joins may be split by Spark where one id has very many links.
    """
    # Links go from the larger to the smaller id.
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = stage(large.where("u <> v").distinct(), f"{name}-large")
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        small = hung.join(stage(least, f"{name}-least"), "u")
        turned = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = stage(turned.where("u <> v").distinct(), name)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
        before = now


def document_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest id reachable over links, itself included.

    ``digest``, a hash of the text, tells rows of one id apart, and ``component``, a fingerprint, names the group.
    Documents with equal fingerprints are one node, so ids may be any numbers. A NULL text counts as empty (fingerprint
    zero, linked like any other). A NULL id has its row; its component_id is NULL where no document with an id can be
    reached. Rows that repeat an id each get a row, and link nothing by their id. An empty table gives no rows.
    """
    prints = stage(fingerprints(docs), "fingerprints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = components(link_pairs(distinct.select("fp", F.col("fp").alias("rep")), radius), "near-links")
    joined = distinct.join(found.withColumnRenamed("id", "fp"), "fp", "left")
    classes = stage(joined.select("fp", "least", F.coalesce("component", "fp").alias("component")), "fingerprint-groups")
    smallest = stage(classes.groupBy("component").agg(F.min("least").alias("component_id")), "group-names")
    named = stage(classes.join(smallest, "component").select("fp", "component", "component_id"), "fingerprint-classes")
    return prints.join(named, "fp").select("doc_id", "digest", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint and component_id of every document, as ``document_groups`` has them."""
    return document_groups(docs, radius).select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest id.

    Rows of one id with different texts are documents of their own; of those in one group one stays. Rows that are equal
    in id and text are one document. Rows without an id are kept: nothing names them.
    """
    found = document_groups(docs.select("doc_id", "text"), radius).where("doc_id IS NOT NULL")
    named = found.groupBy("component").agg(F.min(F.struct("doc_id", "digest")).alias("kept"))
    digest = free_name(docs, "digest")
    named = named.select(F.col("kept.doc_id").alias("doc_id"), F.col("kept.digest").alias(digest))
    once = docs.where("doc_id IS NOT NULL").withColumn(digest, F.xxhash64(whole())).dropDuplicates(["doc_id", digest])
    kept = once.join(named, ["doc_id", digest], "left_semi")
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
