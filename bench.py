"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Every query is
built and fully computed (a sink that discards rows) once to warm up the JVM and is then
timed on a second, complete run.
"""

from __future__ import annotations

import json
import os
import sys
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "Q1_corridor_congestion_summary",
    "Q2_high_congestion_corridors",
    "Q3_day_type_congestion_summary",
    "Q4_festival_congestion_summary",
    "Q5_holiday_congestion_summary",
    "Q6_day_of_week_congestion_summary",
    "Q7_festival_corridor_analysis",
    "Q8_top5_average_congestion_corridors",
    "Q9_top5_high_congestion_percentage_corridors",
    "P1_standard_projection",
    "P8_chronological_split",
    "P10_page_filters",
    "J1_calendar_left_join",
    "J4_corridors_on_route",
    "A1_class_distribution",
    "A6_weighted_metrics",
    "A11_scenario_comparison",
    "A16_corridor_advisory_rollup",
    "K1_null_counts",
    "K3_surplus_duplicates",
    "K8_raw_file_findings",
    "K10_strict_read_issues",
    "V3_historical_advisories",
    "V4_predicted_advisories",
    "G5_advisory_checks",
    "R4_route_reasons",
    "R10_one_answer_per_query",
    "S6_stage_round_trip",
    "S11_table_fingerprint",
    "M6_rebuilt_from_specification",
]


def main() -> None:
    from roadgrain.plans.all_queries import QUERIES
    from roadgrain.session import build_session

    spark = build_session(
        "roadgrain-bench",
        master=f"local[{CPUS}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
