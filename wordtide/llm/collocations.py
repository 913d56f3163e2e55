"""Phrases whose words occur together more than their parts do, mined over a prefix-free parse of the texts.

Texts are cut into pieces at punctuation, and pieces into chunks wherever a hash of two adjacent words says so, so that
equal passages are cut alike wherever they stand. A chunk is followed by the next three words of its piece; it *owns*
the n-grams that begin before those, and so every n-gram of up to four words is owned by one chunk. The distinct chunks
with their numbers are the dictionary. N-grams are counted inside distinct chunks only, weighted by these numbers.

Words are counted first, by the parse itself, then pairs of frequent words, then triples and fours of frequent pairs.
What is frequent is told by a bit table of hashes that misses none; counts themselves are made from the words, never from hashes. The bit
table follows the number of frequent words or pairs, up to ``MOST_BITS``; when it gets full, more rare n-grams are
counted for nothing, and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordtide.llm.common import stage, whole

LONGEST = 4
LEAST, TOP = 30, 2000
# Shares in which each language is ranked before the last ranking, which so gets a bounded number of rows.
SHARES = 64
# A chunk ends before every pair of words whose hash is a multiple of this.
TRIGGER = 16
# Bytes of text that a task works on at once.
AT_ONCE = 4_000_000
# log2 of the most bits in the table of frequent n-grams: 32 MB.
MOST_BITS = 28

BLANKS, BREAKS = b" \t", b".,;:!?\n\v\f\r"
KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)] = 1
KIND[list(BREAKS)] = 2
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
FACTOR, MIXER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIXER
    return h ^ (h >> np.uint64(29))


PARSED = ["lang", "chunk", "owned", "times"]


class Words:
    """The words of a buffer: each one's code in the buffer's own list of distinct words, and the hash of that word."""

    def __init__(self, buffer: np.ndarray, is_word: np.ndarray):
        edge = np.diff(is_word.astype(np.int8), prepend=0, append=0)
        self.starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.bytes = buffer[is_word]
        self.offsets = np.concatenate([[0], np.cumsum(ends - self.starts)])
        array = pa.Array.from_buffers(pa.string(), len(self.starts), [None, pa.py_buffer(self.offsets.astype(np.int32)), pa.py_buffer(self.bytes)])
        coded = array.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct = coded.dictionary

    def hashes(self) -> np.ndarray:
        known = [xxhash.xxh64_intdigest(w) for w in self.distinct.cast(pa.binary()).to_pylist()]
        return np.array(known, np.uint64)[self.codes]

    def __len__(self) -> int:
        return len(self.starts)

    def spaced(self) -> tuple[bytes, np.ndarray]:
        """All words with a space after each, and where each word begins."""
        n = len(self)
        out = np.full(len(self.bytes) + n, 32, np.uint8)
        out[np.arange(len(self.bytes)) + np.repeat(np.arange(n), np.diff(self.offsets))] = self.bytes
        return out.tobytes(), self.offsets + np.arange(n + 1)


def gathered(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Batches put together until they hold ``AT_ONCE`` bytes in ``column``."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(batch.schema.get_field_index(column)).nbytes
        if size >= AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def joined(table: pa.Table, column: str) -> tuple[bytes, np.ndarray]:
    """All values with a line feed after each, and where each begins."""
    values = table.column(column).cast(pa.binary()).to_pylist()
    begins = np.concatenate([[0], np.cumsum([len(v) + 1 for v in values])])
    return b"\n".join(values) + b"\n", begins


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to chunks: lang, chunk (its words with spaces between), owned (the words whose n-grams it owns), times (1).

    The different words of the texts follow, each as a chunk that owns nothing, with its times.
    """
    for table in gathered(batches, "text"):
        data, begins = joined(table, "text")
        buffer = np.frombuffer(data.translate(LOWER), np.uint8)
        kind = KIND[buffer]
        words = Words(buffer, kind == 0)
        n = len(words)
        if not n:
            continue
        piece = np.cumsum(kind == 2)[words.starts]
        new_piece = np.diff(piece, prepend=-1) != 0
        hashes = words.hashes()
        pair = mix(np.concatenate([[np.uint64(0)], hashes[:-1]]) * FACTOR + hashes)
        first = np.flatnonzero(new_piece | (pair % np.uint64(TRIGGER) == 0))
        last = np.append(first[1:], n)
        piece_ends = np.append(np.flatnonzero(new_piece)[1:], n)
        until = np.minimum(last + LONGEST - 1, piece_ends[np.cumsum(new_piece)[first] - 1])
        text, at = words.spaced()
        chunks = [text[a:b] for a, b in zip(at[first].tolist(), (at[until] - 1).tolist())]
        doc = np.searchsorted(begins, words.starts[first], "right") - 1
        langs = table.column("lang").combine_chunks()
        ones = np.ones(len(first), np.int64)
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(doc)), pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(last - first, pa.int32()), pa.array(ones)], PARSED)
        coded = langs.dictionary_encode()
        of_words = np.diff(np.searchsorted(words.starts, begins))
        lang, word, times = numbers(np.repeat(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), of_words), words)
        none = np.zeros(len(word), np.int32)
        yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(lang)), words.distinct.take(pa.array(word)), pa.array(none), pa.array(times)], PARSED)


def numbers(lang: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each language's different words: codes of language and word, and how often the word stands there."""
    number, size = lang * len(words.distinct) + words.codes, (int(lang.max()) + 1) * len(words.distinct)
    # Few languages: a place for every language and word takes no more room than the words themselves.
    if size <= 2 * len(words):
        times = np.bincount(number, minlength=size)
        found = np.flatnonzero(times)
        times = times[found]
    else:
        found, times = np.unique(number, return_counts=True)
    return found // len(words.distinct), found % len(words.distinct), times


class Parsed:
    """Chunks as words: of which chunk each word is, and how many words are left in it from there on."""

    def __init__(self, table: pa.Table, column: str):
        data, _ = joined(table, column)
        buffer = np.frombuffer(data, np.uint8)
        self.words = Words(buffer, (buffer != 32) & (buffer != 10))
        self.chunk = np.cumsum(buffer == 10)[self.words.starts]
        size = np.bincount(self.chunk, minlength=table.num_rows)
        self.at = np.arange(len(self.words)) - (np.cumsum(size) - size)[self.chunk]
        self.left = size[self.chunk] - self.at
        coded = table.column("lang").combine_chunks().dictionary_encode()
        self.langs, self.lang = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        seeds = np.array([xxhash.xxh64_intdigest(x) for x in self.langs.cast(pa.binary()).to_pylist()], np.uint64)
        self.seed = seeds[self.lang][self.chunk]

    def bits(self, k: int, size: int) -> np.ndarray:
        """The bit, in a table of 2**size, of each word (k = 1) or of it and whatever follows it (k = 2)."""
        h = self.words.hashes()
        seeded = mix(h + self.seed)
        if k == 2:
            seeded = mix(seeded * FACTOR + np.append(h[1:], np.uint64(0)))
        return (seeded >> np.uint64(64 - size)).astype(np.int64)


def count_in(lengths: tuple[int, ...], part: int, frequent: tuple[object, int]):
    """N-grams of distinct chunks (with ``owned`` and ``freq``), whose parts of ``part`` words may all be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "chunk"):
            parsed = Parsed(table, "chunk")
            owned = parsed.at < table.column("owned").to_numpy()[parsed.chunk]
            times = table.column("freq").to_numpy()[parsed.chunk]
            bits, at = np.frombuffer(frequent[0].value, np.uint8), parsed.bits(part, frequent[1])
            known = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            for k in lengths:
                fits = owned & (parsed.left >= k)
                for j in range(k - part + 1):
                    fits[: len(fits) - j] &= known[j:]
                places = np.flatnonzero(fits)
                if len(places):
                    yield folded(parsed, places, times, k)

    return run


def folded(parsed: Parsed, places: np.ndarray, times: np.ndarray, k: int) -> pa.RecordBatch:
    """The different k-grams at the given words, with their weighted number."""
    words = parsed.words
    # A number for each different k-gram, made one word at a time and renumbered before it can pass 64 bits.
    number, below = parsed.lang[parsed.chunk[places]], len(parsed.langs)
    for j in range(k):
        if below * len(words.distinct) >= 2**62:
            distinct, number = np.unique(number, return_inverse=True)
            below = len(distinct)
        number = number * len(words.distinct) + words.codes[places + j]
        below *= len(words.distinct)
    order = np.argsort(number, kind="stable")
    starts = np.flatnonzero(np.diff(number[order], prepend=-1))
    total = np.add.reduceat(times[places[order]], starts)
    one = places[order[starts]]
    parts = [words.distinct.take(pa.array(words.codes[one + j])) for j in range(k)]
    return pa.RecordBatch.from_arrays(
        [parsed.langs.take(pa.array(parsed.lang[parsed.chunk[one]])), pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0], pa.array(total, pa.int64())],
        ["lang", "phrase", "f"],
    )


def bit_numbers(k: int, size: int):
    """The bit of each phrase of k words in a table of 2**size bits, counted from 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "phrase"):
            parsed = Parsed(table, "phrase")
            yield pa.RecordBatch.from_arrays([pa.array(parsed.bits(k, size)[parsed.at == 0] + 1)], ["bit"])

    return run


def bit_table(phrases: DataFrame, k: int) -> tuple[object, int]:
    """A broadcast bit table of the hashes of phrases of k words, and the log2 of its bits.

    About 16 bits a phrase while ``MOST_BITS`` allows, which also bounds what passes through the driver.
    """
    spark = phrases.sparkSession
    size = min(MOST_BITS, max(15, (16 * phrases.count()).bit_length()))
    bits = phrases.mapInArrow(bit_numbers(k, size), "bit BIGINT")
    blocks = bits.groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    table = bytearray(2**size // 8)
    for block, part in blocks.toLocalIterator():
        begin = (block - 1) * len(part)
        table[begin : begin + len(part)] = part
    return spark.sparkContext.broadcast(bytes(table)), size


def parse_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct chunks of all texts: lang, chunk, owned and freq, how often the chunk stands in the texts. And the
    words: lang, phrase, f. Both come of one parse and one shuffle."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole().alias("text"))
    parsed = texts.mapInArrow(parse, "lang STRING, chunk STRING, owned INT, times BIGINT")
    counted = stage(parsed.groupBy("lang", "chunk", "owned").agg(F.sum("times").alias("freq")), "parse-dictionary")
    return counted.where("owned > 0"), counted.where("owned = 0").select("lang", F.col("chunk").alias("phrase"), F.col("freq").alias("f"))


def parse_dictionary(docs: DataFrame) -> DataFrame:
    return parse_texts(docs)[0]


def frequent_phrases(dictionary: DataFrame, all_words: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The words, the pairs, and the triples and fours that occur at least ``least`` times: lang, phrase, f."""

    def counted(counter, name: str) -> DataFrame:
        total = dictionary.mapInArrow(counter, "lang STRING, phrase STRING, f BIGINT").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        return stage(total.where(F.col("f") >= least), name)

    words = stage(all_words.where(F.col("f") >= least), "words")
    pairs = counted(count_in((2,), 1, bit_table(words, 1)), "pairs")
    return words, pairs, counted(count_in((3, 4), 2, bit_table(pairs, 2)), "longer")


def lowest_cut(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Each candidate's cut of the lowest score: lang, phrase, a, l, r, score. Products are 38-digit decimals."""
    words = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("tail")
    )
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    score = F.expr("(2000000BD * CAST(a AS DECIMAL(20,0))) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def inside_longer(candidates: DataFrame) -> DataFrame:
    """For each phrase of two words or more inside a longer candidate, the highest count of such a candidate."""
    words = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("w") - 1),
            lambda k: F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " ")),
        )
    )
    longer = candidates.select("lang", "a", words.alias("w")).where(F.size("w") > 2)
    return longer.select("lang", F.explode_outer(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases.

    Texts are taken in lower case (A-Z only), cut at ``. , ; : ! ?`` and line ends, and into words at blanks and tabs.
    A phrase has two to four words and occurs ``a >= least`` times. Cut in two, its parts occur l and r times and its
    score is floor(2,000,000 a / (l + r)); the lowest-scoring cut counts, of equal ones the first. Phrases inside a
    longer one that occurs at least 80 % as often go. n is the number of words of the language.

    A NULL lang is ``und``, a NULL text empty; texts without words and empty tables give nothing; equal rows count each.
    Other columns are not read. A task's memory depends on ``AT_ONCE`` and on the longest text.
    """
    dictionary, all_words = parse_texts(docs)
    words, pairs, longer = frequent_phrases(dictionary, all_words, least)
    candidates = pairs.unionByName(longer).withColumnRenamed("f", "a")
    scored = lowest_cut(candidates, words.unionByName(pairs).unionByName(longer))
    judged = scored.join(inside_longer(candidates), ["lang", "phrase"], "left")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    kept = judged.where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * 80))
    first = F.desc("score"), F.desc("a"), "phrase"
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    likely = kept.withColumn("share", share).withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*first)))
    ranked = likely.where(F.col("place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*first))).where(F.col("rank") <= top)
    sizes = dictionary.groupBy("lang").agg(F.sum(F.col("owned") * F.col("freq")).alias("n"))
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
