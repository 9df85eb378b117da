"""Times the headline queries and prints one JSON line.

Reads ``BENCH_SF_DIR`` (default sf0.1) on ``local[BENCH_CPUS]``; each query runs once to warm up the
session's code paths on its own plan and once timed, both times writing all rows to a no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalogue import registry  # noqa: E402
from skillgrid.session import build_session  # noqa: E402

HEADLINE = [
    "e0_brier_by_forecast_day",
    "e1_temperature_verification",
    "e2_precipitation_verification",
    "e3_observed_heat",
    "e4_heat_month",
    "e5_canonical_cases",
    "e6_regional_verification",
    "e7_model_climatology",
    "e8_scorecard_job",
    "e9_inventory_and_coverage",
    "e10_coverage_and_brier",
    "e11_case_study",
    "e12_single_case",
    "j1_valid_time_match",
    "ag6_local_solar_day",
    "en6_quantile_levels",
    "mg5_named_reductions",
    "cl1_calendar_day_percentiles",
    "cl2_circular_quantile",
    "cl4_model_quantile",
    "wn1_observed_onset",
    "wn2_member_onset",
    "ws3_deterministic_statistics",
    "ws6_reliability_statistics",
    "sd1_scorecard",
    "au1_coverage_audit",
    "stc_map_cap",
    "st2_running_statistics",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    # Shuffle partitions follow the cores of one machine; on a cluster AQE coalesces from a large number.
    spark = build_session(
        f"local[{cpus}]", "bench", **{"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.driver.memory": "16g", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in wanted:
        cold[name] = round(run(spark, name, sf_dir), 3)
        warm[name] = round(run(spark, name, sf_dir), 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_warm_wall_time",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": float(found.group(1)) if found else None,
                "cpus": cpus,
                "pyspark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
