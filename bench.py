"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores. Each query is run
whole, its result written to a sink that keeps nothing. BENCH_QUERIES, a comma-separated list, limits the run.
"""

from __future__ import annotations

import json
import os
import time

from rollfeat.queries import QUERIES
from rollfeat.session import build_session

HEADLINES = [
    "staging_join",
    "features_preset_a",
    "features_preset_b",
    "features_preset_a_orders",
    "roll_multi_col",
    "roll_hot_key",
    "roll_chunked_orders",
    "incremental_full",
    "dq_unique",
    "ingest_customer",
    "asof_customer",
    "asof_per_feature",
    "asof_hot_entity",
    "serve_point_in_time",
    "hash_sample",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    spark = build_session(
        "rollfeat-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            # The tables are small: let every core have a share of them.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["weekday"](spark, sf_dir))  # starts the executors and reads a file once
    seconds = {}
    for name in names:
        started = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
