"""Report tables: distributions, trends, key figures, model listings, timings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.fixed_values import NEGATIVE, NEUTRAL, POLARITY_NEGATIVE, POLARITY_POSITIVE, POSITIVE
from wordtide.operators.wordstats import count_by


def sentiment_counts(scored: DataFrame) -> DataFrame:
    return count_by(scored, "sentiment")


def sentiment_pivot(scored: DataFrame) -> DataFrame:
    """One row with a column per class; classes that do not occur are 0."""
    sentiment = F.col("sentiment")
    return scored.agg(
        F.count_if(sentiment == POSITIVE).alias("positive"),
        F.count_if(sentiment == NEGATIVE).alias("negative"),
        F.count_if(sentiment == NEUTRAL).alias("neutral"),
    ).withColumn("total", F.col("positive") + F.col("negative") + F.col("neutral"))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent to one decimal; NULL when there is nothing to share."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), 1)


def sentiment_trends(scored: DataFrame) -> DataFrame:
    """Count and share of each class."""
    counts = sentiment_counts(scored)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(
        F.col("sentiment").alias("label"),
        F.col("n").alias("count"),
        percent(F.col("n"), total).alias("percentage"),
    )


def kpi_summary(posts: DataFrame) -> DataFrame:
    """Totals and shares of positive and negative posts."""
    counts = posts.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("polarity") == POLARITY_POSITIVE).alias("positive"),
        F.count_if(F.col("polarity") == POLARITY_NEGATIVE).alias("negative"),
    )
    return counts.select(
        "*",
        percent(F.col("positive"), F.col("total")).alias("pct_positive"),
        percent(F.col("negative"), F.col("total")).alias("pct_negative"),
    )


def daily_trend(scored: DataFrame, ts: str = "ts") -> DataFrame:
    """Positive and negative counts of every day between the first and the last, empty days included."""
    per_day = scored.groupBy(F.to_date(ts).alias("day")).agg(
        F.count_if(F.col("sentiment") == POSITIVE).alias("positive"),
        F.count_if(F.col("sentiment") == NEGATIVE).alias("negative"),
    )
    known = per_day.where(F.col("day").isNotNull())
    # The days come from the same shuffle as their counts, so the messages are read once.
    span = known.agg(F.min("day").alias("first"), F.max("day").alias("last")).where(F.col("first").isNotNull())
    days = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    return days.join(known, "day", "left").select("day", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("positive", "negative")))


def source_polarity_counts(posts: DataFrame) -> DataFrame:
    return count_by(posts, "source", "polarity").orderBy("source", "polarity")


def source_label_rollup(posts: DataFrame) -> DataFrame:
    """Counts per source and polarity with a total per source and a grand total.

    ``level`` is 0 for a count, 1 for a source total, 3 for the grand total. Totals are added up from
    the counts, so the posts are aggregated once and not repeated per level.
    """
    counts = count_by(posts, "source", "polarity")
    return counts.rollup("source", "polarity").agg(
        F.sum("n").alias("n"), F.grouping_id().cast("int").alias("level")
    )


def recent_predictions(scored: DataFrame, n: int = 20, ts: str = "ts", key: str = "event_id") -> DataFrame:
    """The latest ``n`` predictions, ties by key."""
    return scored.orderBy(F.desc(ts), F.asc(key)).limit(n)


def preview(posts: DataFrame, n: int = 5, width: int = 50) -> DataFrame:
    """The first ``n`` posts by id with a short snippet each."""
    return posts.select("id", "text").orderBy("id").limit(n).select("id", F.left("text", F.lit(width)).alias("snippet"))


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the highest F1; among equals the one listed first."""
    return metrics.orderBy(F.desc("f1"), F.asc("position")).limit(1)


def model_comparison(metrics: DataFrame, names: list[str]) -> DataFrame:
    """One row per model and metric."""
    return metrics.unpivot("model_name", names, "metric", "value")


def model_metadata(metrics: DataFrame, folds: int, feature_column: str, version: str = "1.0") -> DataFrame:
    """The record of the winner, or no row when nothing was trained."""
    trained = metrics.agg(F.count("*")).scalar()
    return best_model(metrics).select(
        F.col("model_name").alias("best_model"),
        F.col("f1").alias("best_f1"),
        F.col("accuracy").alias("best_accuracy"),
        trained.alias("total_models_trained"),
        F.lit(folds).alias("cv_folds"),
        F.lit(feature_column).alias("feature_column"),
        F.lit(version).alias("version"),
    )


def throughput_report(runs: DataFrame, baseline: str) -> DataFrame:
    """Throughput of each method, its speedup in time and its gain in throughput over the baseline method.

    ``runs`` has ``method``, ``records``, ``seconds``, one row per method. Zero divisors give NULL.
    """
    rate = F.try_divide(F.col("records").cast("double"), F.col("seconds"))
    base = runs.where(F.col("method") == baseline)
    base_seconds, base_rate = base.select("seconds").scalar(), base.select(rate).scalar()
    return runs.select(
        "method",
        "records",
        F.round("seconds", 6).alias("seconds"),
        F.round(rate, 6).alias("throughput"),
        F.round(F.try_divide(base_seconds, F.col("seconds")), 6).alias("speedup"),
        F.round((F.try_divide(rate, base_rate) - 1) * 100, 6).alias("gain_pct"),
    )


def rows_per_partition(df: DataFrame) -> DataFrame:
    """How many rows each partition of ``df`` has; empty partitions are not listed."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))


def partition_balance(df: DataFrame) -> DataFrame:
    """One row: partitions with rows, all rows, and the fewest and most rows of a partition."""
    return rows_per_partition(df).agg(
        F.count("*").alias("partitions"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.min("n").alias("fewest"),
        F.max("n").alias("most"),
    )
