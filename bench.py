"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). Each query runs once to warm up, then the median of the
repeats counts; results are forced with a ``noop`` write.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidepanel import catalogue  # noqa: E402
from tidepanel.session import local_session  # noqa: E402
from tidepanel.sources.star import Star  # noqa: E402

HEADLINE = [
    *[n for n in catalogue.QUERIES if n.startswith("q_uc")],
    "ingest_wide_pairs", "ingest_wide_fields", "dedup_first_wins", "parse_dates_multi", "rolling_window_range",
    "ntile_quartiles", "membership_exits", "ext_asof_available", "ext_percentiles", "ext_hierarchy_rollup",
]


def seconds(spark, sf_dir: str, name: str) -> float:
    """Building, planning and running one query from scratch."""
    start = time.perf_counter()
    catalogue.run(name, Star(spark, sf_dir)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "tidepanel-bench")
    timings = {}
    for name in names:
        seconds(spark, sf_dir, name)
        timings[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(repeat)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": cpus, "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
