"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Every query runs once to warm up and is
then timed from the call to the last row; the faster of two timings counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from verification.compare import session
from verification.queries import QUERIES

HEADLINE = [
    "complete_entities", "tag_flags_bands", "entity_summary", "entity_compliance", "band_days",
    "hist_naaqs", "ranked_entities", "top_entities", "top_n_frequency", "top_per_region",
    "display_labels", "exceedance_pct_by_year", "year_on_year", "tracked_all_years",
    "flatten_attributes", "status_table", "status_report", "observed_completion",
    "completion_summary", "under_threshold_grid", "calendar_cells", "warn_low_values",
    "duplicate_entries", "rule_report",
]


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(min(seconds(spark, name, folder) for _ in range(2)), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
