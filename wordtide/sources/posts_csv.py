"""Headerless CSV of posts, and the line-by-line forms of reading it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.fixed_values import POLARITY_NEGATIVE, POLARITY_POSITIVE
from wordtide.schemas import POSTS_CSV
from wordtide.sources.quoted_lines import read_records

FIELDS = ["polarity", "id", "date", "query", "user", "text"]


def read_posts(spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """Posts from CSV. Fields that do not fit their type become NULL and fall to the polarity filter.

    Quotes inside a field are doubled. Posts that hold line breaks need ``multi_line``, which reads the files twice:
    once for the quotes of each split and once for the records, both with many tasks for each file. Its encoding must
    have ASCII letters as single bytes, as UTF-8 and ISO-8859-1 do.
    """
    options = {"header": "false", "escape": '"', "encoding": encoding}
    if not multi_line:
        return spark.read.schema(POSTS_CSV).options(**options).csv(path)
    record = F.col("record").cast("string")
    # Bytes that are not UTF-8 become replacement characters, as in the other reader.
    text = F.make_valid_utf8(record) if encoding.upper() in ("UTF-8", "UTF8") else F.decode("record", encoding)
    post = F.from_csv(text, POSTS_CSV, {"escape": '"', "multiLine": "true", "lineSep": "\u0000"})
    return read_records(spark, path).select(post.alias("post")).select("post.*")


def write_posts(posts: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Write the six columns so that ``read_posts`` gives back equal rows."""
    (
        posts.select(*FIELDS)
        .write.mode("overwrite")
        .option("escape", '"')
        .option("quoteAll", True)
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Raw lines in a single-byte encoding, as ``value``."""
    reader = spark.read.schema("value STRING").option("encoding", encoding)
    # The text reader knows only UTF-8, so lines are read as CSV without separator and quotes.
    return reader.option("sep", "\u0001").option("quote", "").csv(path)


def split_line(line: Column) -> Column:
    """The six fields of a raw line. Only the first five commas separate, so the text keeps its own."""
    return F.split(line, ",", 6)


def unquote(field: Column) -> Column:
    return F.translate(field, '"', "")


def sixth_field(line: Column) -> Column:
    """The sixth of all comma-separated fields: the text up to its first own comma, if it has one."""
    return F.get(F.split(line, ",", 7), F.lit(5))


def line_problem(line: Column) -> Column:
    """Why a raw line is not a valid post, or NULL if it is one."""
    fields = split_line(line)
    polarity = unquote(F.get(fields, F.lit(0))).try_cast("int")
    return (
        F.when(F.size(fields) < len(FIELDS), "too_few_fields")
        .when(polarity.isNull(), "bad_polarity")
        .when(~polarity.isin(POLARITY_NEGATIVE, POLARITY_POSITIVE), "unknown_polarity")
        .when(F.length(unquote(F.get(fields, F.lit(5)))) == 0, "empty_text")
    )


def split_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid posts of raw lines, and the quarantined lines with their reasons."""
    judged = lines.withColumn("reason", line_problem(F.col("value")))
    fields = split_line(F.col("value"))
    columns = [unquote(F.get(fields, F.lit(i))).alias(name) for i, name in enumerate(FIELDS)]
    good = judged.where("reason IS NULL").select(columns[0].cast("int").alias("polarity"), *columns[1:])
    return good, judged.where("reason IS NOT NULL")
