"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Each query runs end to end into Spark's ``noop`` sink (full execution, no
collect to the driver), once to warm up and ``$BENCH_REPEAT`` more times;
the per-query figure is the median of the timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.queries import QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402

HEADLINE = ["three_way", "branch_view", "commit_branches", "merge_refs", "wait_commits",
            "list_pull_requests", "put_objects", "fetch_objects", "create_branches", "apply_ref_log"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="strata-bench")
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "repeat": repeat,
                      "settings": {"shuffle_partitions": cpus * 2, "aqe": True}}))


if __name__ == "__main__":
    main()
