"""Times the headline queries over the test data and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all), BENCH_RUNS.
All queries run once to warm up, then BENCH_RUNS times in turn; the median counts. A time covers
building the query and running it into the noop sink, so every row and column is computed; queries
that write tables do so within their time. The jobs (landing, loads, stream) run once, after the
headline queries and outside their total.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from playline.plans.queries import QUERIES
from playline.session import build, scratch_path

HEADLINE = [
    "fact_media_engagement",
    "fact_events",
    "dim_visitor",
    "events_received_after",
    "events_for_listed_media",
    "unmatched_events",
    "media_engagement_lookup",
    "engagement_by_media",
    "engagement_by_country",
    "engagement_by_visitor",
    "daily_events",
    "event_interactions",
    "events_until_empty_page",
    "events_append_new",
]


JOBS = [
    "landed_events",
    "daily_load",
    "date_range_load",
    "two_batches_one_run",
    "streamed_events",
    "landed_visitor_pages",
]

PARQUET = "fact_media_engagement_parquet"


def to_noop(name, spark, sf_dir):
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def to_parquet(_name, spark, sf_dir):
    """The engagement fact written as the job writes it."""
    path = scratch_path(spark, "bench")
    start = time.perf_counter()
    fact = QUERIES["fact_media_engagement"](spark, sf_dir)
    fact.write.partitionBy("load_date").parquet(path)
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build(
        "playline-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or [*HEADLINE, PARQUET]
    times = {name: [] for name in chosen}
    for _ in range(runs + 1):
        for name in chosen:
            timed = to_parquet if name == PARQUET else to_noop
            times[name].append(timed(name, spark, sf_dir))
    timings = {name: round(statistics.median(spent[1:]), 3) for name, spent in times.items()}
    jobs = {} if sys.argv[1:] else {name: round(to_noop(name, spark, sf_dir), 3) for name in JOBS}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "jobs": jobs,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
