"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores. Each query is
run once to warm up and then ``BENCH_RUNS`` times (default 3); its median counts. A run includes the
plan, all intermediate tables, and the full result written to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clinspark.queries import QUERIES  # noqa: E402
from clinspark.session import build_session  # noqa: E402

HEADLINE = (
    "relink", "reassign_orphans", "delete_orphans", "first_encounter", "dedup_by_id", "dedup_rows",
    "load_table", "codes_all", "codes_lookup", "note_segments", "fk_audit", "visit_rollup",
    "visit_assign", "surrogate_key", "concept_map", "event_union", "first_value_window", "note_files",
    "provider_lists", "omop_visit", "omop_drug_exposure",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "total of median query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
