"""The streaming job: messages to scored rows, quarantined rows, live counts and a live trend.

``python -m wordtide.plans.live --servers <host:port> --topic <name> --out <folder>``
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordtide.fixed_values import MESSAGE_TIME_FORMAT, STREAM_LEXICON
from wordtide.operators.reports import sentiment_counts
from wordtide.schemas import MESSAGE
from wordtide.session import build_session
from wordtide.streaming.scoring import score_messages, trend
from wordtide.streaming.sinks import start_merge, start_sink
from wordtide.streaming.sources import kafka_options, stream_source


def scored_messages(raw: DataFrame, lexicon: Mapping[str, int] = STREAM_LEXICON) -> DataFrame:
    """Parsed and scored messages with their typed time ``ts``, the raw ``value`` and a ``reason`` where one is bad.

    Messages without text have no sentiment. A message with text but without a readable time is scored, and named.
    """
    typed = raw.select(F.col("value").cast("string").alias("value"), F.from_json(F.col("value").cast("string"), MESSAGE).alias("data"))
    typed = typed.select("value", "data.*").withColumn("ts", F.try_to_timestamp("timestamp", F.lit(MESSAGE_TIME_FORMAT)))
    reason = F.when(F.col("text").isNull(), "no text").when(F.col("ts").isNull(), "no time")
    return score_messages(typed, lexicon).withColumn("reason", reason)


def start_all(raw: DataFrame, out: str, available_now: bool = False) -> dict[str, StreamingQuery]:
    """Start the four sinks below ``out``. Each keeps its own checkpoint, so each can fail and resume alone.

    ``quarantine`` has every message that a table lacks, as it came: those without text, and those whose time can't be
    read and which ``live_trend`` therefore doesn't count.
    """
    scored = scored_messages(raw)
    known = scored.where(F.col("sentiment").isNotNull())
    timed = known.where(F.col("ts").isNotNull()).select("ts", "sentiment")
    at = lambda name: (f"{out}/{name}", f"{out}/checkpoints/{name}")
    return {
        "stream_predictions": start_sink(known.drop("value", "reason"), *at("stream_predictions"), available_now=available_now),
        "quarantine": start_sink(
            scored.where(F.col("reason").isNotNull()).select("value", "reason"), *at("quarantine"), available_now=available_now
        ),
        "live_counts": start_merge(known.select("sentiment"), sentiment_counts, *at("live_counts"), available_now),
        "live_trend": start_merge(timed, lambda df: trend(df, "ts", "1 day"), *at("live_trend"), available_now),
    }


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic", required=True)
    parser.add_argument("--out", required=True, help="folder for tables and checkpoints, shared by all executors")
    args = parser.parse_args()
    spark = build_session("live")
    start_all(stream_source(spark, "kafka", **kafka_options(args.servers, args.topic)), args.out)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
