"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rosterflow.checks.queries import QUERIES  # noqa: E402
from rosterflow.session import build_session, run_folder  # noqa: E402

# runs after one warm-up run; the long composed loads are run less often
HEADLINES = {
    "collapse_first_non_null": 3,
    "asof_applicant_talent": 3,
    "asof_talent_course": 3,
    "pivot_traits": 3,
    "explode_map_junction": 3,
    "iddate_ffill": 3,
    "dense_id_one": 3,
    "synthetic_keys": 3,
    "duplicate_rows": 3,
    "junction_semi": 3,
    "applicant_tables": 3,
    "talent_merged": 1,
    "academy_tables": 1,
    "linked_talent": 1,
    "name_join": 1,
    "tech_by_name": 1,
    "star_load": 1,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="rosterflow-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, runs in HEADLINES.items():
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            with run_folder(spark):
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
