"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores. The nested inputs are derived and
stored first (reported as ``setup``), as the jobs read stored tables; each query is then planned
and run in full, best of BENCH_RUNS.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import registry  # noqa: E402
from checks.compare import session  # noqa: E402
from checks.standin import standin  # noqa: E402
from shelfwise import refresh_lookups  # noqa: E402
from shelfwise.sources import INPUTS  # noqa: E402

# Scans, reports and whole jobs. Steps of the job are left out: their queries read what the query
# before them stored, so their times would say nothing.
HEADLINE = (
    "scan_buyable_rate", "scan_orders",
    "report_gmv_by_partner_type", "report_opportunity_by_platform", "email_payload",
    "gap_v1", "gap_v2", "gap_platform_preset", "gap_all",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(cpus, cpus)
    start = time.perf_counter()
    inputs = standin(spark, sf_dir)
    for name in INPUTS:
        getattr(inputs, name)
    inputs.lookups, inputs.by_month.buyable_rate, inputs.by_month.orders, inputs.gap_result  # noqa: B018
    setup = time.perf_counter() - start

    def timed(run) -> float:
        best = float("inf")
        for _ in range(runs):
            begin = time.perf_counter()
            run()
            best = min(best, time.perf_counter() - begin)
        return round(best, 3)

    built = registry.queries()
    times = {
        "lookup_refresh": timed(lambda: refresh_lookups(spark, inputs, f"{inputs.root}/lookups-again"))
    }
    for name in HEADLINE:
        times[name] = timed(
            lambda: built[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    print(json.dumps({
        "metric": "headline queries, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "setup": round(setup, 3),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
