"""Best-fit packing of token sequences through a configuration linear program.

A configuration is a multiset of piece lengths that fits one sequence. The program asks for the fewest configurations
that cover the histogram of lengths. It is solved over the lengths alone, whose number is bounded by the sequence
length, by multiplicative weights: every round prices the lengths, a knapsack dynamic program finds the most valuable
configuration, a share of it is added, and the weights of the lengths that it covers fall. The counts stay whole all the
while. The gathered configurations are rounded down, what remains is packed by best fit, and the whole is compared with
best fit alone; the plan of fewer sequences is used. Every round's prices also give a bound that no packing can go below.
Pieces then get their places by their rank within their length, on the executors.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordtide.llm.common import by_batch, give_back, map_frames, stage, whole
from wordtide.llm.tokens import BYTE_BPE, REMEMBERED, encoder

SEQUENCE = 2048
ROUNDS = 600
END_ID = 0

PIECES = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT, ids BINARY, part INT, nth BIGINT"
PLACES = "sequence_id BIGINT, offset BIGINT"
# Counts of pieces by length and part that are broadcast, 2,048 for each part of the input; more of them are joined.
MOST_COUNTS = 1_000_000

# One line of a plan: pieces of ``length`` ranked ``first`` and on go to sequences from ``sequence`` on, ``each`` to a
# sequence, the first of them at ``offset``.
Run = tuple[int, int, int, int, int]


def best_configuration(value: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, Counter]:
    """The most valuable multiset of ``sizes`` within ``room`` and its value, by the unbounded knapsack's program."""
    worth, place = np.full(room + 1, -np.inf), np.full(room + 1, -1)
    worth[sizes], place[sizes] = value, np.arange(len(sizes))
    # Stored from the largest space down, so that all last pieces of a space are one slice.
    best, last = np.zeros(room + 1), np.zeros(room + 1, "i8")
    for space in range(1, room + 1):
        sums = best[room - space + 1 :][:space] + worth[1 : space + 1]
        k = int(sums.argmax())
        if sums[k] > best[room - space + 1]:
            best[room - space], last[space] = sums[k], k + 1
        else:
            best[room - space] = best[room - space + 1]
    taken: Counter = Counter()
    space = room
    while space > 0:
        size = int(last[space])
        if size:
            taken[int(place[size])] += 1
        space -= size or 1
    return float(best[0]), taken


# Each step covers at most this share of a length, and lowers its weight by this power of e for a full cover.
SHARE, STEEP = 0.05, 8.0
CHECKED = 60


def solve(sizes: np.ndarray, counts: np.ndarray, room: int, rounds: int, reached: int = 0) -> tuple[list[tuple[Counter, float]], float]:
    """Configurations with the number of times each is used, and the program's greatest lower bound seen.

    Rounds end early, at the next ``CHECKED`` one, if the bound shows that a plan of ``reached`` sequences can't be beaten.

    The covering program by multiplicative weights: a length's weight falls exponentially with the share of it that has
    been covered, its price is its weight by its count. Any prices y bound the number of sequences from below by the
    pieces' worth through the worth of the best configuration, which is the program's dual.
    """
    counts = counts.astype(float)
    covered, bound = np.zeros(len(sizes)), float(math.ceil((sizes * counts).sum() / room))
    used: dict[tuple, float] = {}
    # The first prices are the lengths themselves; weights then bend them towards what is covered least.
    start = sizes / room
    for turn in range(rounds):
        if turn and turn % CHECKED == 0 and math.ceil(bound - 1e-6) >= reached:
            break
        price = start * np.exp(-STEEP * (covered - covered.min()))
        value, taken = best_configuration(price, sizes, room)
        bound = max(bound, float((price * counts).sum()) / value)
        times = min(SHARE * counts[k] / n for k, n in taken.items())
        key = tuple(sorted(taken.items()))
        used[key] = used.get(key, 0.0) + times
        for k, n in taken.items():
            covered[k] += n * times / counts[k]
    # The rounds cover everything several times over where lengths are few: their average is the answer.
    whole = float((covered * counts * sizes).sum() / (counts * sizes).sum()) or 1.0
    return [(Counter(dict(key)), times / whole) for key, times in used.items()], bound


def best_fit(left: dict[int, int], room: int) -> list[tuple[Counter, int]]:
    """Best fit, longest first, over a histogram: configurations and how often each is used.

    Equal sequences are one entry, so the work depends on the number of lengths and not on that of pieces.
    """
    done: list[tuple[Counter, int]] = []
    # For each space, the open sequences that have it: contents and number.
    spaces: list[int] = []
    held: dict[int, list[tuple[Counter, int]]] = {}

    def put(space: int, content: Counter, times: int, least: int) -> None:
        if times and space < least:
            done.append((content, times))
        elif times:
            if space not in held:
                insort(spaces, space)
            held.setdefault(space, []).append((content, times))

    least = min((n for n, c in left.items() if c), default=0)
    for n in sorted((n for n, c in left.items() if c), reverse=True):
        count = left[n]
        while count:
            at = bisect_left(spaces, n)
            if at == len(spaces):
                space, content, times = room, Counter(), -(-count // (room // n))
            else:
                space = spaces[at]
                content, times = held[space].pop()
                if not held[space]:
                    del held[space]
                    spaces.pop(at)
            each = space // n
            full = min(times, count // each)
            put(space - each * n, content + Counter({n: each}), full, least)
            count -= full * each
            if full < times:
                if count:
                    put(space - count * n, content + Counter({n: count}), 1, least)
                    full, count = full + 1, 0
                if content:
                    put(space, content, times - full, least)
    return done + [entry for group in held.values() for entry in group]


def rounded(solution: list[tuple[Counter, float]], sizes: np.ndarray, histogram: dict[int, int], room: int) -> list[tuple[Counter, int]]:
    """Whole numbers of the program's configurations, never beyond the counts, and best fit for the rest."""
    left, plan = dict(histogram), []
    for configuration, times in sorted(solution, key=lambda x: -x[1]):
        lengths = {int(sizes[k]): n for k, n in configuration.items()}
        whole = min(int(times), *(left[n] // each for n, each in lengths.items()))
        if whole:
            plan.append((Counter(lengths), whole))
            for n, each in lengths.items():
                left[n] -= each * whole
    return plan + best_fit(left, room)


def plan_of(histogram: dict[int, int], room: int, rounds: int) -> tuple[list[tuple[Counter, int]], float]:
    """The better of program and best fit for the lengths below ``room``, and the lower bound on sequences."""
    sizes = np.array(sorted(histogram), "i8")
    counts = np.array([histogram[int(n)] for n in sizes], "i8")
    plain = best_fit(histogram, room)
    solution, bound = solve(sizes, counts, room, rounds, sequences(plain))
    return min(rounded(solution, sizes, histogram, room), plain, key=sequences), bound


def sequences(plan: list[tuple[Counter, int]]) -> int:
    return sum(times for _, times in plan)


def pack_lengths(histogram: dict[int, int], room: int = SEQUENCE, rounds: int = ROUNDS) -> list[Run]:
    """The plan for a histogram of lengths from 1 to ``room``. Its size is bounded by rounds and ``room``."""
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(not 0 < n <= room for n in left):
        raise ValueError(f"lengths must be from 1 to {room}")
    sequence, next_rank, runs = 0, Counter(), []
    full = left.pop(room, 0)
    plan = [(Counter({room: 1}), full)] if full else []
    if left:
        plan += plan_of(left, room, rounds)[0]
    for configuration, times in plan:
        offset = 0
        for n, each in sorted(configuration.items(), reverse=True):
            runs.append((n, next_rank[n], sequence, each, offset))
            next_rank[n] += each * times
            offset += n * each
        sequence += times
    return runs


def _cut(tokenizer: str, room: int, end: int, keep_ids: bool, remembered: int):
    tail = np.array([end], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen: Counter = Counter()
        for batch in batches:
            out = []
            for doc, ids in zip(batch["doc_id"].tolist(), encoder(tokenizer, remembered).encode(batch["text"])):
                ids += tail
                n = len(ids) // 4
                first = n % room or room
                at = 0
                for piece, to in enumerate(range(first, n + 1, room)):
                    some = ids[4 * at : 4 * to]
                    out.append((None if doc is pd.NA else doc, piece, at, to - at, zlib.crc32(some), some if keep_ids else None, part, seen[to - at]))
                    seen[to - at] += 1
                    at = to
            yield out

    return run


def cut_documents(
    docs: DataFrame, tokenizer: str = BYTE_BPE, room: int = SEQUENCE, end: int = END_ID, keep_ids: bool = False, remembered: int = REMEMBERED
) -> DataFrame:
    """Pieces of the documents' ids, each document closed by ``end``. Only documents longer than ``room`` are cut, into
    pieces of ``room``, of which the first may be shorter. ``ids`` holds them as little-endian 32-bit numbers.
    ``remembered`` bounds the words that a worker keeps; it changes the memory and the time, not the ids. A part's documents
    are taken in the order of their ids, which ``nth`` follows; this needs no shuffle."""
    texts = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text")).sortWithinPartitions("doc_id")
    return map_frames(texts, _cut(tokenizer, room, end, keep_ids, remembered), PIECES)


def place(pieces: DataFrame, room: int = SEQUENCE, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces with ``part``, ``length`` and ``nth``.

    Pieces are numbered within their length: those of one part by the task that made them, in ``nth``, then the parts are
    counted up. So no length, however frequent, meets in one task, and pieces with their ids are not shuffled. Only the
    histogram, at most ``room`` rows, reaches the driver.
    """
    counts = stage(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = pack_lengths(histogram, room, rounds)
    below = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("length", "part", F.coalesce(below, F.lit(0)).alias("_below"))
    few = counts.count() <= MOST_COUNTS
    ranked = pieces.join(F.broadcast(starts) if few else starts, ["length", "part"])
    return map_frames(ranked.withColumn("_rank", F.col("_below") + F.col("nth")), _placed(runs, room), f"{PIECES}, {PLACES}")


def _placed(runs: list[Run], room: int):
    table = np.array(sorted(runs), "i8").reshape(-1, 5)
    # One number that orders by length and then rank; a length has fewer than 2^48 pieces.
    keys = (table[:, 0] << 48) + table[:, 1]

    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        length, rank = batch["length"].to_numpy("i8"), batch["_rank"].to_numpy("i8")
        line = table[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
        over = rank - line[:, 1]
        batch["sequence_id"] = line[:, 2] + over // line[:, 3]
        batch["offset"] = line[:, 4] + length * (over % line[:, 3])
        return batch.drop(columns=["_below", "_rank"])

    def run(batches):
        # All documents are encoded by now; the words that the worker remembers are of no more use.
        encoder.cache_clear()
        give_back()
        yield from by_batch(rows)(batches)

    return run


def pack_documents(docs: DataFrame, tokenizer: str = BYTE_BPE, room: int = SEQUENCE, keep_ids: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """Places of all pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ``ids`` if kept.

    A NULL or empty text is one piece that holds only the end id. Rows that repeat a document, or have no id, are packed
    like any other. An empty table gives no rows. Other columns are not read.
    """
    pieces = stage(cut_documents(docs, tokenizer, room, keep_ids=keep_ids, remembered=remembered), "pieces")
    placed = place(pieces, room).drop("part", "nth")
    return placed if keep_ids else placed.drop("ids")
