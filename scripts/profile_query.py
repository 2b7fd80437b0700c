"""Per-stage timings of one query from Spark's event log (written to a scratch folder).

Usage: python scripts/profile_query.py <query> [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402

from strata.plans.queries import QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402


def main():
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-evlog-")
    spark = build_session(shuffle_partitions=16, extra={"spark.eventLog.enabled": "true",
                                                        "spark.eventLog.dir": log_dir})
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()   # warm-up, stores state
    t0 = time.time()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    print(name, "seconds", round(time.time() - t0, 2))
    spark.stop()
    stages = []
    plans = []
    for f in sorted(glob.glob(f"{log_dir}/*/events_*")):
        stream = zstandard.ZstdDecompressor().stream_reader(open(f, "rb"))
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            e = json.loads(line)
            if e["Event"].endswith("SparkListenerSQLAdaptiveExecutionUpdate"):
                plans.append(e.get("physicalPlanDescription", ""))
            if e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                d = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                scopes = []
                for r in si["RDD Info"]:
                    try:
                        scopes.append(json.loads(r.get("Scope", "{}")).get("name", ""))
                    except Exception:  # noqa: BLE001
                        pass
                stages.append((d, si["Stage ID"], si["Number of Tasks"], sorted(set(scopes))[:8]))
    half = len(stages) // 2
    print("stages in timed run ~", len(stages) - half)
    for d, sid, n, sc in sorted(stages[half:], reverse=True)[:8]:
        print(round(d, 2), sid, n, sc)
    if plans:
        out = os.path.join(log_dir, "final_plan.txt")
        open(out, "w").write(plans[-1])
        print("final plan:", out)


if __name__ == "__main__":
    main()
