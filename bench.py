"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is run to completion with the ``noop`` sink (every row and
column produced, nothing collected); the reported time is the median of
``$BENCH_RUNS`` (default 3) runs after one warm-up. The yardsticks are the
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "guest_night_ledger", "guest_night_ledger_sql", "reservation_detail", "inhouse_today",
    "reservation_extract", "loyalty_statement", "fiscal_outcomes", "fiscal_documents",
    "shared_stay_flag", "repeat_guest_flag", "asof_stay_rate", "slot_share_priority", "fiscal_stream",
]

def main() -> None:
    from nightaudit.session import get_session
    from nightaudit.registry import REGISTRY

    spark = get_session(f"local[{CPUS}]", shuffle_partitions=int(CPUS) * 2, app="nightaudit-bench")
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    sf = float(m.group(1)) if m else None

    def timed(make):
        times = []
        for i in range(RUNS + 1):
            t0 = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            if i:  # first run warms up
                times.append(time.perf_counter() - t0)
        return round(statistics.median(times), 3)

    results = {}
    for name in HEADLINE:
        results[name] = timed(lambda: REGISTRY[name](spark, SF_DIR))
    total = round(sum(results.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": results, "sf": sf,
                      "cpus": int(CPUS), "runs": RUNS}))


if __name__ == "__main__":
    main()
