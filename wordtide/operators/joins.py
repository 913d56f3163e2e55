"""Joins against lookup tables whose size or key skew must not matter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 10_000


def counted_join(facts: DataFrame, counted: DataFrame, key: str, count: str, share: int = HOT_SHARE) -> DataFrame:
    """Inner join of ``facts`` to a table that states how many facts each of their keys has.

    Keys with at least one fact in ``share`` are broadcast; counts add up to the number of facts, so there can be
    no more than ``share`` such keys, whatever the data. The other keys are joined by shuffle, where none of them
    holds more than one fact in ``share``. ``counted`` is read three times and should be a written table.
    """
    total = counted.agg(F.sum(count)).scalar()
    hot = counted.where(F.col(count) * share >= total)
    cold = counted.where(F.col(count) * share < total)
    on_hot = facts.join(F.broadcast(hot), key)
    on_cold = facts.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return on_hot.unionByName(on_cold)
