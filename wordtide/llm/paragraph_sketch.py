"""Document fingerprints that can be subtracted: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: lines, and within a line its sentences, whatever their script. So a cut depends on the
text around it alone, and an edit moves no cut elsewhere. The set of their digests is kept in 40 cells, four groups of
ten; each digest is counted and combined by exclusive or in one cell of every group. Two sketches subtract cell by cell,
what they share cancels out, and the rest is peeled: a cell that holds one digest gives it away, taking it out of its
other cells gives away more. Where the counts that are left tell of more digests than 40 cells give away, and where
peeling stops too soon, a larger sketch is tried: the digests are dealt by their hash to 2, 4, 8 and so on to 65,536
sketches of 40 cells, which together are one larger sketch. The first of them that does not peel ends a try. If the
largest fails too, the sets themselves are subtracted, so every answer is exact. Built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordtide.llm.common import let, stage, whole

# A line's end, spaces after a sentence's end, or the end of a sentence in a script that sets no space after it. Each place
# is looked at for a line feed or a space first, which most are not; few texts hold one of the last ends.
UNSPACED = "。！？｡"
SPACED_END = rf"\n+| (?<=[.!?؟۔։।॥።{UNSPACED}] ) *"
PARAGRAPH_END = rf"{SPACED_END}|(?<=[{UNSPACED}])(?![{UNSPACED} ])"
GROUPS, SLOTS = 4, 10
CELLS = GROUPS * SLOTS
# Sketches that are tried, one after the other: 2 to this power, in as many rows as columns or twice as many.
LEVELS = tuple(range(17))
ROUNDS = 12
# Differences that 40 cells are meant for: most sketches of so many peel.
LOAD = 16
# Ranges of ids that are ordered on their own, and rows that one is meant for.
MOST_RANGES, RANGE_ROWS = 4_096, 4_000


def digests(text: Column) -> Column:
    """The set of paragraph digests, as 64-bit numbers."""
    unspaced = reduce(or_, [F.contains(text, F.lit(c)) for c in UNSPACED])
    parts = F.when(unspaced, F.split(text, PARAGRAPH_END)).otherwise(F.split(text, SPACED_END))
    return F.array_distinct(F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(77))


def _marked(keys: Column, level: Column) -> Column:
    """Each digest with its cells as bits of one number, its check, hash bits that choose its sketch, and a count of 1."""

    def mark(key: Column) -> Column:
        def bits(h: Column) -> Column:
            cells = None
            for g in range(GROUPS):
                slot = (F.shiftrightunsigned(h, 8 * g) if g else h).bitwiseAND(F.lit(255)) % F.lit(SLOTS).cast("bigint")
                bit = F.call_function("shiftleft", F.lit(1 << g * SLOTS).cast("bigint"), slot.cast("int"))
                cells = bit if cells is None else cells.bitwiseOR(bit)
            return F.struct(
                key.alias("k"), _check(key).alias("c"), cells.alias("m"), F.shiftrightunsigned(h, 33).cast("int").alias("h"), F.lit(1).alias("n")
            )

        return let(F.xxhash64(key, level), bits)

    return F.transform(keys, mark)


def _merged(cell: Column, x: Column, n: Column) -> Column:
    """A cell with the digests of another or with a marked one: digests, checks and marks by xor, and the given count."""
    return F.struct(cell["bit"].alias("bit"), n.alias("n"), *[cell[name].bitwiseXOR(x[name]).alias(name) for name in "kcm"])


def _minus(marked: Column) -> Column:
    return F.transform(marked, lambda x: F.struct(x["k"].alias("k"), x["c"].alias("c"), x["m"].alias("m"), x["h"].alias("h"), F.lit(-1).alias("n")))


def _cells(marked: Column) -> Column:
    """The cells of marked digests, each with its bit: counts by plus and minus; digests, checks and marks by xor."""
    zero = F.lit(0).cast("bigint")

    def cell(bit: Column) -> Column:
        empty = F.struct(bit.alias("bit"), F.lit(0).alias("n"), *[zero.alias(name) for name in "kcm"])
        return F.aggregate(F.filter(marked, lambda x: x["m"].bitwiseAND(bit) > 0), empty, lambda a, x: _merged(a, x, a["n"] + x["n"]))

    return F.transform(F.array(*[F.lit(1 << i).cast("bigint") for i in range(CELLS)]), cell)


def _filled(cell: Column) -> Column:
    return (cell["n"] != 0) | (cell["k"] != 0) | (cell["c"] != 0)


def _subtracted(a: Column, b: Column) -> Column:
    """The cells of one sketch less those of another, those that are not empty: counts by minus, the others by xor."""

    return F.filter(F.zip_with(a, b, lambda x, y: _merged(x, y, x["n"] - y["n"])), _filled)


def _likely_level(cells: Column, a: Column, b: Column) -> Column:
    """The level whose sketches are likely to peel, from the cells that are left of two sets of ``a`` and ``b`` digests.

    Of d digests that stay, each adds 1 to the squared counts of a group and, with any other, 2 / SLOTS or -2 / SLOTS on
    average, as they are of one side or not. So the squares of all groups tell d, which is no less than the sizes' difference.
    """
    squares = F.aggregate(cells, F.lit(0.0), lambda s, x: s + x["n"].cast("double") * x["n"])
    more = F.abs(a - b).cast("double")
    different = F.greatest(more, (squares * (SLOTS / GROUPS) - more * more) / (SLOTS - 1), F.lit(1.0))
    return F.least(F.greatest(F.ceil(F.log2(different / LOAD)), F.lit(LEVELS[0])), F.lit(LEVELS[-1])).cast("int")


def _peel(cells: Column) -> Column:
    """(left, right, open): digests that only the left or right sketch has, and whether some could not be recovered.

    All cells that hold one digest are peeled in a round, and emptied ones go; after a round without any to peel, nothing
    is looked at again. Such a cell tells the digest's other cells as well.
    """
    none = F.array().cast("array<bigint>")

    def step(s: Column, _: Column) -> Column:
        alone = F.filter(s["cells"], lambda x: F.when(F.abs(x["n"]) == 1, _check(x["k"]) == x["c"]).otherwise(False))
        marks = F.transform(alone, lambda x: F.struct(x["k"].alias("k"), x["c"].alias("c"), x["m"].alias("m"), x["n"].alias("n")))

        def side(found: Column, sign: int) -> Column:
            return F.transform(F.filter(found, lambda x: x["n"] == sign), lambda x: x["k"])

        def less(cell: Column, found: Column) -> Column:
            return F.aggregate(found, cell, lambda a, x: F.when(x["m"].bitwiseAND(a["bit"]) > 0, _merged(a, x, a["n"] - x["n"])).otherwise(a))

        def taken(found: Column) -> Column:
            touched = F.aggregate(found, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x["m"]))
            rest = let(touched, lambda bits: F.transform(s["cells"], lambda x: F.when(bits.bitwiseAND(x["bit"]) == 0, x).otherwise(less(x, found))))
            return F.struct(
                F.filter(rest, _filled).alias("cells"),
                F.concat(s["left"], side(found, 1)).alias("left"),
                F.concat(s["right"], side(found, -1)).alias("right"),
                F.lit(False).alias("still"),
            )

        def stepped(found: Column) -> Column:
            return F.when(F.size(found) == 0, s.withField("still", F.lit(True))).otherwise(taken(found))

        return F.when(s["still"], s).otherwise(let(F.array_distinct(marks), stepped))

    start = F.struct(cells.alias("cells"), none.alias("left"), none.alias("right"), F.lit(False).alias("still"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        step,
        lambda s: F.struct(s["left"].alias("left"), s["right"].alias("right"), (F.size(s["cells"]) > 0).alias("open")),
    )


def _numbers(found: Column) -> Column:
    """How many digests were recovered of either side; NULL if some could not be."""
    return F.when(~found["open"], F.struct(F.size(found["left"]).alias("a"), F.size(found["right"]).alias("b")))


def _subtract(marked: Column, level: Column) -> Column:
    """Numbers of digests counted 1 and -1 that the sketches of a level hold in the end; NULL if one doesn't peel.

    Digests are dealt in two steps, so that each is looked at once for every row and column of sketches and not for
    every sketch. Both sides go into the same cells: what their sketches less each other would hold.
    """
    zero = F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"))
    rows, columns = F.shiftright(level + 1, 1), F.shiftright(level, 1)

    def over(marked: Column, skip: Column, power: Column, inner) -> Column:
        last = F.call_function("shiftleft", F.lit(1), power) - 1

        def dealt(place: Column) -> Column:
            return F.filter(marked, lambda x: F.call_function("shiftright", x["h"], skip).bitwiseAND(last) == place)

        def add(done: Column, place: Column) -> Column:
            def of(share: Column) -> Column:
                part = F.when(F.size(share) == 0, zero).otherwise(inner(share))
                return let(part, lambda r: F.when(r.isNotNull(), F.struct((done["a"] + r["a"]).alias("a"), (done["b"] + r["b"]).alias("b"))))

            return F.when(done.isNotNull(), let(dealt(place), of))

        return F.aggregate(F.sequence(F.lit(0), last), zero, add)

    def one(share: Column) -> Column:
        return let(_peel(F.filter(_cells(share), _filled)), _numbers)

    def column(share: Column) -> Column:
        return over(share, rows, columns, one)

    return over(marked, F.lit(0), rows, column)


def sketched(keys: Column) -> Column:
    """A set of digests with their marks and its smallest sketch: keys, marks, cells."""
    return let(_marked(keys, F.lit(LEVELS[0])), lambda marks: F.struct(keys.alias("keys"), marks.alias("marks"), _cells(marks).alias("cells")))


def _differences(a: Column, b: Column) -> Column:
    """``differences`` of two sets as ``sketched`` gives them. Later tries mark anew, so that what collided parts."""
    x, y = a["keys"], b["keys"]
    exact = F.struct(F.size(F.array_except(x, y)).alias("a"), F.size(F.array_except(y, x)).alias("b"))
    none = F.lit(None).cast("struct<a:int,b:int>")

    def tried(cells: Column, least: Column) -> Column:
        def attempt(done: Column, level: Column) -> Column:
            left, right = F.when(level == least, a["marks"]).otherwise(_marked(x, level)), F.when(level == least, b["marks"]).otherwise(_marked(y, level))
            dealt = let(F.concat(left, _minus(right)), lambda marked: _subtract(marked, level))
            smallest = let(_peel(cells), _numbers)
            return F.when(done.isNotNull(), done).when(level < least, none).when(level == LEVELS[0], smallest).otherwise(dealt)

        return F.aggregate(F.array(*map(F.lit, LEVELS)), none, attempt)

    def answer(cells: Column) -> Column:
        return let(_likely_level(cells, F.size(x), F.size(y)), lambda least: tried(cells, least))

    return F.coalesce(let(_subtracted(a["cells"], b["cells"]), answer), exact)


def differences(a: Column, b: Column) -> Column:
    """How many digests only ``a`` and only ``b`` have: the first sketch that peels decides, from the likely one up."""
    return let(sketched(a), lambda x: let(sketched(b), lambda y: _differences(x, y)))


def likeness(a: Column, b: Column) -> Column:
    """Shared digests over all digests of two sets as ``sketched`` gives them, from what their sketches' difference
    recovers. Two empty sets: 1."""

    def share(d: Column) -> Column:
        return F.coalesce(F.try_divide((F.size(a["keys"]) - d["a"]).cast("double"), (F.size(a["keys"]) + d["b"]).cast("double")), F.lit(1.0))

    return let(_differences(a, b), share)


def recovered(a: Column, b: Column) -> Column:
    """The digests themselves that two sets don't share, by the smallest sketch if it peels: left, right, open."""
    return _peel(_subtracted(sketched(a)["cells"], sketched(b)["cells"]))


def fingerprint(cells: Column) -> Column:
    """The smallest sketch as text: count, digests and checks of each cell in hex; checks are shortened to 32 bits."""

    def cell(x: Column) -> Column:
        digest = F.concat(F.lpad(F.hex(x["k"]), 16, "0"), F.lpad(F.hex(x["c"].bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
        return F.concat(F.hex(x["n"].cast("bigint")), F.lit(":"), F.when(x["n"] == 0, "").otherwise(digest))

    return F.lower(F.array_join(F.transform(cells, cell), "."))


def with_next(docs: DataFrame, made: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """doc_id, text and next_text: the text of the next document by id, after the last the first.

    ``made`` adds columns made of the text, and the next document's as ``next_`` and the name; each is made once.

    Ids are cut into ranges by approximate quantiles; a range is ordered on its own. The first document of each range is
    added to the range before it, so that no range looks into another and the text is shuffled once. Rows without an id
    come first, rows with one id are ordered by text.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"))
    rows = texts.select("doc_id").count()
    ranges = max(1, min(MOST_RANGES, -(-rows // RANGE_ROWS)))
    cuts = texts.select("doc_id").approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges) if ranges > 1 else []
    splits = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    placed = Bucketizer(splits=splits, inputCol="_id", outputCol="range").transform(
        texts.withColumn("_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-1e300"))))
    ).drop("_id")
    # At most one row for each range from here to ``heads``.
    firsts = placed.groupBy("range").agg(F.min("doc_id").alias("least"), F.bool_or(F.col("doc_id").isNull()).alias("none"))
    firsts = firsts.select("range", F.when(~F.col("none"), F.col("least")).alias("head"))
    by_range = Window.orderBy("range")
    whole_range = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("range").over(by_range), F.last("range").over(whole_range))
    firsts = stage(firsts.withColumn("before", before), "range-firsts")
    wanted = placed.join(F.broadcast(firsts), "range").where(F.col("doc_id").eqNullSafe(F.col("head")))
    heads = wanted.groupBy("before").agg(F.min("text").alias("text")).select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.col("before").alias("range"), F.lit(True).alias("guest"))
    all_rows = placed.withColumn("guest", F.lit(False)).unionByName(heads)
    columns = {"text": F.col("text"), **{name: make(F.col("text")) for name, make in (made or {}).items()}}
    all_rows = all_rows.select("doc_id", "range", "guest", *[c.alias(name) for name, c in columns.items()])
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return all_rows.select("*", *[F.lead(name).over(order).alias(f"next_{name}") for name in columns]).where("NOT guest").select(
        "doc_id", *columns, *[f"next_{name}" for name in columns]
    )


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    The edited text has its last quarter of characters replaced by the first as many of the next document. A NULL text
    counts as empty: no paragraphs, an empty sketch, likeness 1 to another empty one. Repeated rows each get a row and
    are each other's next; a single row is its own next. An empty table gives no rows.
    """
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - cut), F.substr("next_text", F.lit(1), cut))
    texts = with_next(docs, {"own": digests}).select("doc_id", n.cast("bigint").alias("n_chars"), F.inline(F.array(F.struct("own", "next_own", edited.alias("edited")))))
    keys = texts.select(
        "doc_id", "n_chars", F.inline(F.array(F.struct(F.sha2("edited", 256).alias("edited_sha256"), "own", digests(F.col("edited")).alias("new"), F.col("next_own").alias("next"))))
    )
    sketches = keys.select("doc_id", "n_chars", "edited_sha256", F.inline(F.array(F.struct(F.transform(F.array("own", "new", "next"), sketched).alias("s")))))
    own = F.col("s")[0]
    prints = F.transform(F.slice("s", 1, 2), lambda x: fingerprint(x["cells"]))
    near = F.transform(F.slice("s", 2, 2), lambda x: likeness(own, x))
    answers = sketches.select("doc_id", "n_chars", "edited_sha256", F.inline(F.array(F.struct(prints.alias("p"), near.alias("n")))))
    return answers.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.col("p")[0].alias("fingerprint"),
        F.col("p")[1].alias("edited_fingerprint"),
        F.col("n")[0].alias("near_edited"),
        F.col("n")[1].alias("near_next"),
    )
