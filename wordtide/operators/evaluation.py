"""Classification metrics from aggregates, without one job per metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordtide.session import stage

METRICS = ["accuracy", "precision", "recall", "f1"]


def confusion_counts(predictions: DataFrame, *by: str) -> DataFrame:
    """Rows per label and predicted label."""
    return predictions.groupBy(
        *by, F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction")
    ).agg(F.count("*").alias("n"))


def classification_metrics(predictions: DataFrame, *by: str, digits: int = 4) -> DataFrame:
    """Accuracy and label-weighted precision, recall and F1, in one pass over the predictions.

    Only the confusion counts, at most classes squared rows per group, go further.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), zero.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), zero.alias("actual"), F.col("n").alias("predicted"), zero.alias("hits")),
    )
    per_class = (
        confusion_counts(predictions, *by)
        .select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(*(F.sum(c).alias(c) for c in ("actual", "predicted", "hits")))
    )
    none = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hits", "predicted"), none)
    recall = F.coalesce(F.try_divide("hits", "actual"), none)
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), none)

    def weighted(value):
        return F.round(F.try_divide(F.sum(value * F.col("actual")), F.sum("actual")), digits)

    return per_class.groupBy(*by).agg(
        F.round(F.try_divide(F.sum("hits"), F.sum("actual")), digits).alias("accuracy"),
        weighted(precision).alias("precision"),
        weighted(recall).alias("recall"),
        weighted(f1).alias("f1"),
    )


# Ranges that different scores are dealt to.
SCORE_RANGES = 200


def auc_roc(predictions: DataFrame, score: str = "score", digits: int = 6) -> DataFrame:
    """Area under the ROC curve: the share of positive-negative pairs ranked right, ties counting half.

    Exact for any scores. Infinite scores are the ends of the order; rows with a NULL or NaN score are left out. Equal
    scores are folded and written first, and what follows reads those. The different scores are dealt to ranges at their
    quantiles, and negatives are summed inside each range on its own; a range starts from the negatives of the ranges
    below it. Quantiles need not be exact: they only decide how even the ranges are.
    """
    counts = predictions.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    # Missing scores are left out only now: an earlier filter would move below the score and compute it twice.
    known = stage(counts, "scores").where(F.col("score").isNotNull() & ~F.isnan("score"))
    shares = [i / SCORE_RANGES for i in range(1, SCORE_RANGES)]
    cuts = known.agg(F.array_distinct(F.percentile_approx("score", shares, 10 * SCORE_RANGES))).scalar()
    ranges = known.withColumn("cuts", cuts).withColumn("range", F.size(F.filter("cuts", lambda cut: cut < F.col("score")))).drop("cuts")
    starts = ranges.groupBy("range").agg(F.sum("neg").alias("neg"))
    starts = starts.select("range", running_negatives(Window.orderBy("range")).alias("start"))
    inside = ranges.withColumn("inside", running_negatives(Window.partitionBy("range").orderBy("score")))
    placed = inside.join(F.broadcast(starts), "range").select("pos", "neg", (F.col("start") + F.col("inside")).alias("lower"))
    # Halves are counted as whole numbers to stay exact: 2 for a pair ranked right, 1 for a tie.
    twice = F.col("pos").cast("decimal(38,0)") * (2 * F.col("lower") + F.col("neg")).cast("decimal(20,0)")
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return placed.agg(F.round(F.try_divide(F.sum(twice).cast("double") / 2, pairs), digits).alias("auc"))


def running_negatives(window) -> Column:
    """Negatives before each row of an ordered window."""
    return F.coalesce(F.sum("neg").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
