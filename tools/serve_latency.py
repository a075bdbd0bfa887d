"""Q1 latency in the serving shape: the latest table is maintained (by the
stream, or written once here) and the map list reads it, as the reference's
list endpoint reads its store.  Prints median and slowest of N runs
(limit=100, sort lastSeen desc, default bbox — the reference's load test)."""

from __future__ import annotations

import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyfold.operators.latest import build_latest  # noqa: E402
from skyfold.plans.flights import list_flights  # noqa: E402
from skyfold.session import get_session  # noqa: E402
from skyfold.sources.sinks import write_latest  # noqa: E402
from skyfold.sources.testdata import Tables  # noqa: E402


def main(sf: str = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), runs: int = 10) -> None:
    spark = get_session("local[8]")
    t = Tables(spark, sf)
    d = tempfile.mkdtemp(prefix="skyfold-serve-")
    write_latest(build_latest(t.positions), d + "/latest")
    t.aircraft.write.parquet(d + "/aircraft")
    latest, aircraft = spark.read.parquet(d + "/latest"), spark.read.parquet(d + "/aircraft")

    def once() -> float:
        t0 = time.perf_counter()
        list_flights(latest, aircraft, limit=100).collect()
        return time.perf_counter() - t0

    for _ in range(3):
        once()
    xs = sorted(once() for _ in range(runs))
    print(f"q1 serving: median {statistics.median(xs):.3f} s, slowest of {runs} {xs[-1]:.3f} s")


if __name__ == "__main__":
    main()
