"""Times the headline queries; prints one line of JSON.

Every query is run on a warm session and written to the noop sink; its time is
the median of three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gazette import get_session  # noqa: E402
from gazette.workload import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# One or more queries for every family of operators.
HEADLINE = [
    "route_articles",
    "tick_labels",
    "tick_all_sources",
    "insert_if_absent",
    "point_lookup",
    "normalize_search_pages",
    "normalize_feed_entries",
    "normalize_aggregator_items",
    "normalize_social_posts",
    "parse_raw_messages",
    "extract_page_bodies",
    "validate_enriched_articles",
    "gate_articles",
    "parse_replies",
    "enrich_articles",
    "embed_articles",
    "knn_cosine",
    "knn_many_questions",
    "answer_context",
    "latest_articles",
    "count_by_type",
    "weekly_pass_rate",
    "prune_events",
    "article_gaps",
    "backfill_gaps",
    "staged_messages",
    "dedup_ttl_stream",
]


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = get_session(
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name)
        times[name] = round(statistics.median(seconds(spark, name) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
