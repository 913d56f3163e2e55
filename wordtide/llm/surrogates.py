"""Personal data replaced by surrogates.

Every detected entity gets a replacement of its own type and format: a letter takes the place of a letter, a digit of a
digit, upper case of upper case, vowels of vowels, in the entity's own script, and signs stay where they are. Names
keep their last letter, which carries gender in the languages covered, as does the title before them, which stays.

The replacement is a keyed permutation (a Feistel network over the changeable characters, whose round values come from
SHA-256 of key, type and shape). The first changeable character moves by at least one step, so no entity that has one
is its own surrogate. A permutation maps different entities to different surrogates and the same entity to
the same one, in every document and on every executor, without a table of all entities; a check over all mentions
confirms it, and a key version that fails it is passed over. Only Spark's own expressions are used.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm.common import let, stage, whole

KEY = "wordtide"
ROUNDS = 4
VERSIONS = 8

# Fixed patterns of entity types, tried in this order at every place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])(?:[0-9]{4}(?:[ \-]?[0-9]{4}){3}|3[47][0-9]{2}[ \-]?[0-9]{6}[ \-]?[0-9]{5})(?![A-Za-z0-9])",
    "ssn": r"(?<![A-Za-z0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9+(])(?:(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)[ .\-]?|[0-9]{2,4}[ .\-])(?:[0-9]{2,4}[ .\-]){0,3}[0-9]{3,8}|\+[0-9]{1,3}[ .\-]?[0-9]{6,12})(?![A-Za-z0-9])",
    # The plain looks at both sides come first: the long look back at a title is rarely needed.
    "name": r"(?<= )(?=\p{Lu})(?<=\b(?:Mr|Mrs|Ms|Dr|Sr|Sra|Mme)\.? |\b(?:Herr|Frau|Señor|Señora|Monsieur|Madame) |\b(?:господин|госпожа) )\p{Lu}\p{L}+(?:[ \-]\p{Lu}\p{L}+){0,2}",
}
ENTITY = "|".join(PATTERNS.values())
# Every entity has a digit, an @ or a title before it: a quick look that spares most texts the patterns.
POSSIBLE = r"[0-9@]"
TITLED = r"\b(?:M(?:rs?|s|me|onsieur|adame)|Dr|Sra?|Herr|Frau|Señora?|господин|госпожа)\.? \p{Lu}"

# Alphabets a character is replaced within.
ALPHABETS = (
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "AEIOU",
    "BCDFGHJKLMNPQRSTVWXYZ",
    "аеиоуэюя",
    "бвгджзклмнпрстфхцчшщ",
    "АЕИОУЭЮЯ",
    "БВГДЖЗКЛМНПРСТФХЦЧШЩ",
)


def _other_alphabets(known: str) -> tuple[str, ...]:
    """Alphabets of all other letters with case: by script, case, block, and whether the letter without accents is a vowel."""
    groups = defaultdict(str)
    for c in map(chr, range(128, 0x10000)):
        case = unicodedata.category(c)
        if case in ("Lu", "Ll") and c not in known:
            vowel = unicodedata.normalize("NFD", c)[0].lower() in "aeiouæøœαεηιουωаеиоуэюяыієաեէըիոօ"
            groups[unicodedata.name(c).split()[0], case, ord(c) >> 8 if ord(c) > 0x17F else ord(c) >> 7, vowel] += c
    single = defaultdict(str)
    for (_, case, *_), letters in groups.items():
        if len(letters) == 1:
            single[case] += letters
    return tuple(x for x in (*groups.values(), *single.values()) if len(x) > 1)


FIRST_ALPHABETS = len("".join(ALPHABETS))
ALPHABETS += _other_alphabets("".join(ALPHABETS))
# All alphabets one after the other, and where each starts.
LETTERS = "".join(ALPHABETS)
STARTS = [0, *accumulate(map(len, ALPHABETS))]
# Country calling codes: no code is the beginning of another.
COUNTRY = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
TITLES = {
    "male": ("mr", "herr", "señor", "sr", "monsieur", "господин"),
    "female": ("mrs", "ms", "frau", "señora", "sra", "mme", "madame", "госпожа"),
}


def entity_type(value: Column) -> Column:
    """The type of a found entity: the first pattern that it is as a whole."""
    kind = F.lit("name")
    for name in reversed([x for x in PATTERNS if x != "name"]):
        # A look to the left has nothing to see at the start of the value; the rest of the pattern decides.
        kind = F.when(value.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
    return kind


def gender(before: Column) -> Column:
    """What the title in front of a name says."""
    title = F.lower(F.regexp_extract(before, r"(\p{L}+)\.? $", 1))
    return F.when(title.isin(*TITLES["male"]), "male").when(title.isin(*TITLES["female"]), "female").otherwise("unknown")


def script(value: Column) -> Column:
    return F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsLatin}"), "latin").otherwise("none")


def _codes(characters: Column) -> Column:
    """Each character as (alphabet, place in it, size); characters of no alphabet have size 0 and stay."""

    def code(c: Column) -> Column:
        def placed(at: Column) -> Column:
            def within(a: Column) -> Column:
                start = F.get(starts, a)
                return F.struct(a.alias("a"), (at - start).alias("p"), (F.get(starts, a + 1) - start).alias("n"), c.alias("c"))

            # The last alphabet that starts at or before the letter.
            return F.when(at < 0, none).otherwise(let(F.when(at < FIRST_ALPHABETS, F.size(F.filter(first_starts, lambda x: x <= at))).otherwise(F.size(F.filter(starts, lambda x: x <= at))) - 1, within))

        none = F.struct(F.lit(-1).alias("a"), F.lit(0).alias("p"), F.lit(0).alias("n"), c.alias("c"))
        near = F.instr(F.lit(LETTERS[:FIRST_ALPHABETS]), c)
        far = F.when(c.rlike(r"[^\x00-\x7F]"), F.instr(F.lit(LETTERS), c)).otherwise(0)
        return let(F.when(near > 0, near).otherwise(far) - 1, placed)

    starts = F.array(*map(F.lit, STARTS))
    first_starts = F.array(*map(F.lit, STARTS[:9]))
    return F.transform(characters, code)


def in_round(turn: Callable[[Column, int], Column], number: int) -> Callable[[Column], Column]:
    """A round as a function of the state alone: Spark takes a second parameter for the place in the array."""
    return lambda state: turn(state, number)


def permuted(characters: Column, tweak: Column, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of the strings of one shape: characters move within their alphabets.

    First the first changeable character moves on by a number that a digest of the others gives and that is never 0, so
    no string with such a character stays as it is. It then stays, and the others are permuted under a key of its own.
    Odd and even places are the two halves of a Feistel network: in turn, each half is shifted by numbers that a digest
    of the other half gives. Shifting back undoes a round, so no two strings of a shape meet.
    """

    def hexed(digest: Column) -> Column:
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")

    def anchored(state: Column) -> Column:
        def moved(at: Column) -> Column:
            others = F.array_join(F.transform(state, lambda x, i: F.when(i != at, x["p"].cast("string")).otherwise(F.lit("."))), ",")

            def move(by: Column) -> Column:
                step = lambda x, i: F.when(i == at, x.withField("p", ((x["p"] + 1 + by % (x["n"] - 1)) % x["n"]).cast("int"))).otherwise(x)
                return F.transform(state, step)

            new = F.when(at < 0, state).otherwise(let(hexed(F.sha2(F.concat_ws("|", tweak, F.lit("first"), others), 256)), move))
            return let(new, lambda x: F.struct(x.alias("x"), at.alias("at"), F.coalesce(F.get(x, at)["p"].cast("string"), F.lit("")).alias("lead")))

        return let((F.array_position(F.transform(state, lambda x: x["n"] > 1), True) - 1).cast("int"), moved)

    def turn(whole_state: Column, number: int) -> Column:
        half = number % 2
        state = whole_state["x"]
        # The other half as text; in the half to be changed, only the shape is seen.
        fixed = F.array_join(F.transform(state, lambda x, i: F.when(i % 2 != half, x["p"].cast("string")).otherwise(F.lit("."))), ",")

        def shifted(digest: Column) -> Column:
            def move(x: Column, i: Column) -> Column:
                # Eight hex digits at a time, and a digest of its own for every eight places.
                at = F.floor(i / 2) % 8
                block = F.sha2(F.concat(digest, F.floor(i / 16).cast("string")), 256)
                by = F.conv(F.substr(block, (at * 8 + 1).cast("int"), F.lit(8)), 16, 10).cast("bigint")
                new = ((x["p"] + by) % x["n"]).cast("int")
                return F.when((i % 2 == half) & (x["n"] > 0) & (i != whole_state["at"]), x.withField("p", new)).otherwise(x)

            return F.struct(F.transform(state, move).alias("x"), whole_state["at"].alias("at"), whole_state["lead"].alias("lead"))

        return let(F.sha2(F.concat_ws("|", tweak, F.lit(str(number)), whole_state["lead"], fixed), 256), shifted)

    state = let(_codes(characters), anchored)
    for number in range(rounds):
        state = let(state, in_round(turn, number))

    starts = F.array(*map(F.lit, STARTS))

    def letter(x: Column) -> Column:
        return F.when(x["a"] < 0, x["c"]).when(x["a"] < 9, F.substr(F.lit(LETTERS[:FIRST_ALPHABETS]), F.get(starts, x["a"]) + x["p"] + 1, F.lit(1))).otherwise(
            F.substr(F.lit(LETTERS), F.get(starts, x["a"]) + x["p"] + 1, F.lit(1))
        )

    return F.array_join(let(state, lambda s: F.transform(s["x"], letter)), "")


def valid_ip(value: Column) -> Column:
    return ~F.exists(F.split(value, r"\."), lambda x: x.try_cast("int") > 255)


def canonical(kind: Column, value: Column) -> Column:
    """What two mentions of an entity share: letter case, signs between digits and leading zeros of an IP don't matter.

    The + of a phone number stays, as what follows it is a country's code.
    """
    plain = F.upper(F.regexp_replace(value, "[^A-Za-z0-9]", ""))
    address = F.array_join(F.transform(F.split(value, r"\."), lambda x: x.try_cast("int").cast("string")), ".")
    return (
        F.when(kind == "phone", F.concat(F.when(value.startswith("+"), "+").otherwise(""), plain))
        .when(kind.isin("card", "ssn", "iban"), plain)
        .when((kind == "ip") & valid_ip(value), address)
        .when(kind == "name", value)
        .otherwise(F.lower(value))
    )


def surrogate(kind: Column, value: Column, version: str, key: str = KEY) -> Column:
    """The replacement of a mention, in the mention's own format.

    The canonical form is permuted and laid back into the mention: its signs stay, and a letter takes the case it had.
    Of an e-mail address the part before the @ changes, of an IP address the last three numbers' digits below the
    hundreds, of a name every word by itself, so that first and last names stay recognisable when they stand alone.
    """
    tweak = F.concat_ws("|", F.lit(key), F.lit(version), kind)

    def scrambled(plain: Column, shape: Column) -> Column:
        return permuted(F.split(plain, ""), F.concat_ws("|", tweak, shape))

    def number(v: Column) -> Column:
        """Digits and letters of the canonical form, laid back between the mention's signs."""
        plain = F.regexp_replace(canonical(kind, v), r"^\+", "")
        # An IBAN's country stays, as does a phone's country code, wherever the mention's signs are.
        lead = F.when(kind == "iban", 2).when((kind == "phone") & v.startswith("+"), F.length(F.regexp_extract(plain, COUNTRY, 0))).otherwise(0)
        inner = F.concat(F.substr(plain, F.lit(1), lead), scrambled(F.substr(plain, lead + 1), F.length(plain).cast("string")))
        return let(
            F.struct(inner.alias("new"), F.split(v, "").alias("old")),
            lambda x: F.aggregate(
                x["old"],
                F.struct(F.lit("").alias("out"), F.lit(0).alias("used")),
                lambda s, c: F.when(
                    c.rlike("[A-Za-z0-9]"),
                    F.struct(F.concat(s["out"], F.substr(x["new"], s["used"] + 1, F.lit(1))).alias("out"), (s["used"] + 1).alias("used")),
                ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["used"].alias("used"))),
                lambda s: s["out"],
            ),
        )

    def email(v: Column) -> Column:
        local, host = F.substring_index(F.lower(v), "@", 1), F.substring_index(v, "@", -1)
        new = scrambled(local, F.concat(F.length(local).cast("string"), F.lower(host)))
        upper = F.substring_index(v, "@", 1) == F.upper(F.substring_index(v, "@", 1))
        return F.concat(F.when(upper & v.rlike("[A-Z]"), F.upper(new)).otherwise(new), F.lit("@"), host)

    def ip(v: Column) -> Column:
        """A permutation of the 2^32 addresses: the last number moves on, never by 0; under it, 16 and 8 bits are combined
        with digests of each other."""
        parts = F.transform(F.split(v, r"\."), lambda x: x.try_cast("bigint"))
        by = lambda *seen: F.conv(F.substring(F.sha2(F.concat_ws("|", tweak, *seen), 256), 1, 4), 16, 10).cast("bigint")

        def start(p: Column) -> Column:
            a = p[0] * 256 + p[1]
            d = (p[3] + 1 + by(F.lit("last"), a.cast("string"), p[2].cast("string")) % 255) % 256
            return F.struct(a.alias("a"), p[2].alias("c"), d.alias("d"))

        def turn(s: Column, k: int) -> Column:
            seen = by(F.lit(str(k)), s["d"].cast("string"), s["c" if k % 2 == 0 else "a"].cast("string"))
            return s.withField("a", s["a"].bitwiseXOR(seen)) if k % 2 == 0 else s.withField("c", s["c"].bitwiseXOR(seen % 256))

        state = let(parts, start)
        for k in range(ROUNDS):
            state = let(state, in_round(turn, k))
        return let(state, lambda s: F.concat_ws(".", F.floor(s["a"] / 256).cast("string"), (s["a"] % 256).cast("string"), s["c"].cast("string"), s["d"].cast("string")))

    def no_ip(v: Column) -> Column:
        """Parts beyond 255 move within 256 to 999, the others within what is of their length: it never becomes an IP."""
        parts = F.transform(F.split(v, r"\."), lambda x: F.struct(x.try_cast("bigint").alias("p"), F.length(x).alias("n")))

        def by(state: Column, large: bool, i: Column) -> Column:
            seen = F.array_join(F.transform(state, lambda x: F.when((x["p"] > 255) == large, x["p"].cast("string")).otherwise("")), ".")
            return F.conv(F.substring(F.sha2(F.concat_ws("|", tweak, F.lit("no"), seen, i.cast("string")), 256), 1, 8), 16, 10).cast("bigint")

        def larger(state: Column) -> Column:
            moved = lambda x, i: F.when(x["p"] > 255, x.withField("p", 256 + (x["p"] - 255 + by(state, False, i) % 743) % 744)).otherwise(x)
            return F.transform(state, moved)

        def smaller(state: Column) -> Column:
            size = lambda x: F.when(x["n"] == 1, 10).when(x["n"] == 2, 100).otherwise(256)
            moved = lambda x, i: F.when(x["p"] <= 255, x.withField("p", (x["p"] + by(state, True, i)) % size(x))).otherwise(x)
            return F.transform(state, moved)

        shown = lambda state: F.array_join(F.transform(state, lambda x: F.lpad(x["p"].cast("string"), x["n"], "0")), ".")
        return let(parts, lambda a: let(larger(a), lambda b: let(smaller(b), shown)))

    def name(v: Column) -> Column:
        def word(w: Column) -> Column:
            n = F.length(w)
            # The last letter stays.
            return F.concat(scrambled(F.substr(w, F.lit(1), n - 1), F.concat(n.cast("string"), F.right(w, F.lit(1)))), F.right(w, F.lit(1)))

        spaced = F.regexp_extract_all(v, F.lit(r"[ \-]|\p{L}+"), F.lit(0))
        return F.array_join(F.transform(spaced, lambda w: F.when(F.length(w) > 1, word(w)).otherwise(w)), "")

    return (
        F.when(kind == "email", email(value))
        .when((kind == "ip") & valid_ip(value), ip(value))
        .when(kind == "ip", no_ip(value))
        .when(kind == "name", name(value))
        .otherwise(number(value))
    )


def may_hold(text: Column) -> Column:
    return text.rlike(POSSIBLE) | text.rlike(TITLED)


def _cut(text: Column) -> Column:
    return F.struct(F.split(text, ENTITY, -1).alias("rest"), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)).alias("found"))


def mentions(docs: DataFrame, version: str = "0", key: str = KEY) -> DataFrame:
    """doc_id, number, type, value, canonical, surrogate, gender, script of every entity mentioned in the texts."""
    texts = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text")).where(may_hold(F.col("text")))
    listed = let(
        _cut(F.col("text")),
        lambda x: F.transform(
            x["found"], lambda v, i: F.struct(i.alias("number"), v.alias("value"), F.right(F.get(x["rest"], i), F.lit(16)).alias("before"))
        ),
    )
    found = texts.select("doc_id", F.inline(listed)).withColumn("type", entity_type(F.col("value")))
    kind, value = F.col("type"), F.col("value")
    return found.select(
        "doc_id",
        "number",
        "type",
        "value",
        canonical(kind, value).alias("canonical"),
        surrogate(kind, value, version, key).alias("surrogate"),
        F.when(kind == "name", gender(F.col("before"))).alias("gender"),
        script(value).alias("script"),
    )


def collisions(found: DataFrame) -> DataFrame:
    """Surrogates that stand for more than one entity of their type, and entities with more than one surrogate.

    Both sides are compared in canonical form. Minima and maxima fold before the shuffle, so a common entity is no
    burden.
    """
    pairs = found.select("type", "canonical", canonical(F.col("type"), F.col("surrogate")).alias("new"))
    shared = pairs.groupBy("type", "new").agg(F.min("canonical").alias("a"), F.max("canonical").alias("b"))
    split = pairs.groupBy("type", "canonical").agg(F.min("new").alias("a"), F.max("new").alias("b"))
    return shared.where("a <> b").select("type", "a", "b").unionByName(split.where("a <> b").select("type", "a", "b"))


def checked_version(docs: DataFrame, key: str = KEY) -> str:
    """The first key version whose surrogates keep all entities of ``docs`` distinct and coreferent."""
    for version in map(str, range(VERSIONS)):
        if collisions(stage(mentions(docs, version, key).select("type", "canonical", "surrogate"), "mentions")).isEmpty():
            return version
    raise RuntimeError("no key version keeps the entities distinct; give another key")


def _surrogates(x: Column, version: str, key: str) -> Column:
    return F.transform(x["found"], lambda v: let(entity_type(v), lambda k: surrogate(k, v, version, key)))


def _joined(x: Column, new: Column) -> Column:
    """A cut text put together again with its entities replaced."""
    return F.array_join(F.transform(x["rest"], lambda r, i: F.concat(r, F.coalesce(F.get(new, i), F.lit("")))), "")


def _replaced(x: Column, version: str, key: str) -> Column:
    return let(_surrogates(x, version, key), lambda new: _joined(x, new))


def replaced(text: Column, version: str, key: str = KEY) -> Column:
    """The text with each entity replaced."""
    return F.when(may_hold(text), let(_cut(text), lambda x: _replaced(x, version, key))).otherwise(text)


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """All rows and columns of ``docs`` with surrogates in ``text``; ``n_chars`` stays right where it is given.

    A NULL text stays NULL, an empty one stays empty. Rows are changed one by one, so ids may be missing or repeat.
    """
    version = checked_version(docs, key)
    text = F.col("text").cast("string")
    changed = docs.withColumn("text", replaced(text, version, key))
    return changed.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else changed


def entity_report(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text with surrogates, n_entities, n_changed, types (sorted) of every document."""
    version = checked_version(docs, key)
    none = F.array().cast("array<string>")

    def answer(x: Column) -> Column:
        types = F.array_sort(F.array_distinct(F.transform(x["found"], entity_type)))

        def counted(new: Column) -> Column:
            changed = F.size(F.filter(F.zip_with(x["found"], new, lambda v, w: v != w), lambda c: c))
            return F.struct(_joined(x, new).alias("text"), F.size(new).cast("bigint").alias("n_entities"), changed.cast("bigint").alias("n_changed"), types.alias("types"))

        return let(_surrogates(x, version, key), counted)

    text = F.col("text")
    plain = F.struct(text.alias("text"), F.lit(0).cast("bigint").alias("n_entities"), F.lit(0).cast("bigint").alias("n_changed"), none.alias("types"))
    given = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"))
    found = given.select("doc_id", F.inline(F.array(F.when(may_hold(text), let(_cut(text), answer)).otherwise(plain))))
    return found.withColumn("types", F.array_join("types", ","))
