"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of local cores. Every query is run once to
warm up and then ``BENCH_RUNS`` times, with its full result computed; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "label_counts",
    "clean_text",
    "clean_text_pages",
    "tokenize",
    "stem",
    "processed_text",
    "word_count_letters",
    "word_count_alpha",
    "word_count_raw",
    "word_count_sql",
    "top_words",
    "top_words_by_label",
    "corpus_stats",
    "lexicon_score",
    "lexicon_score_join",
    "substring_score",
    "sentiment_trends",
    "daily_trend",
    "classification_metrics",
    "auc_roc",
    "partitioned_write",
    "tfidf_terms",
    "bigram_vocabulary",
    "stream_score",
    "train_logistic",
]


def timed(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    from wordtide.plans.queries import QUERIES
    from wordtide.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    }
    spark = build_session("bench", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        timed(lambda: QUERIES[name](spark, folder))
        seconds[name] = round(statistics.median(timed(lambda: QUERIES[name](spark, folder)) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
