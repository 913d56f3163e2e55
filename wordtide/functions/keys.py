"""Values derived from keys and names: splits, samples, folds, slugs, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordtide.fixed_values import CV_FOLDS, POST_DATE_FORMAT, RUN_ID_TIME_FORMAT, TRAIN_PERCENT


def key_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    """A bucket from 0 to ``buckets - 1`` that depends on the key alone.

    Unlike a random split it does not change with partitioning, retries or added rows.
    """
    digest = F.md5(F.concat(F.lit(salt), key.cast("string")) if salt else key.cast("string"))
    return F.pmod(F.conv(F.left(digest, F.lit(8)), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def split_name(key: Column, train_percent: int = TRAIN_PERCENT) -> Column:
    return F.when(key_bucket(key, 100) < train_percent, "train").otherwise("test")


def in_sample(key: Column, fraction: float, salt: str = "sample") -> Column:
    """Whether a key belongs to a repeatable sample; ``fraction`` has a resolution of one in 10,000."""
    return key_bucket(key, 10_000, salt) < round(fraction * 10_000)


def fold(key: Column, folds: int = CV_FOLDS, salt: str = "fold") -> Column:
    return key_bucket(key, folds, salt)


def slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def run_id(name: Column, at: Column) -> Column:
    return F.concat_ws("_", name, F.date_format(at, RUN_ID_TIME_FORMAT))


def parse_post_date(date: Column) -> Column:
    """Timestamp of ``Mon Apr 06 22:19:45 PDT 2009``; NULL when it is not such a date."""
    return F.try_to_timestamp(F.regexp_replace(date, "^.{0,4}", ""), F.lit(POST_DATE_FORMAT))


def text_digest(text: str) -> list[Column]:
    """128 bits that tell the texts of one id apart, as columns ``t1`` and ``t2``."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), F.col(text)).alias("t2")]
