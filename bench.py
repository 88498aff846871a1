"""Headline timings: prints one JSON line. Every query computes all its columns (noop sink)."""

from __future__ import annotations

import json
import os
import time

from medalstar.checks.queries import QUERIES, warehouse
from medalstar.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = 2  # the better one counts; the first also warms the JVM

HEADLINE = [
    "stg_ladder", "stg_matches_participants", "dim_champion", "dim_date", "dim_item", "dim_spell",
    "dim_queue_patch", "dim_player", "fct_participant_match",
    "champion_winrate_by_patch", "player_performance", "side_winrate", "objective_impact", "role_analysis",
    "star_join", "dq_report", "ladder_waterfall", "flatten_participants",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def shuffled_bytes(spark) -> int:
    """Shuffle bytes written so far; a local session has the driver as its only executor."""
    time.sleep(0.2)  # the counter follows the jobs by events
    return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()


def main() -> None:
    spark = local_session("medalstar-bench", CPUS, **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.sql.shuffle.partitions": CPUS,
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {"build_warehouse": timed(lambda: warehouse(spark, SF_DIR).build())}
    shuffled = {"build_warehouse": shuffled_bytes(spark)}
    for name in HEADLINE:
        before = shuffled_bytes(spark)
        seconds[name] = min(
            timed(lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
            for _ in range(RUNS)
        )
        shuffled[name] = (shuffled_bytes(spark) - before) // RUNS
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "shuffle_mb": {name: round(value / 1e6, 2) for name, value in shuffled.items()},
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
