"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores).
"""

import json
import os
import sys
import time

from rankline.plans import catalog
from rankline.session import build_session

HEADLINE = (
    "H4_score_to_rank", "H5_rank_to_score", "H6_score_between_years", "H7_schools_by_equivalent_score", "G1_search_schools_by_score_range",
    "G12_top_distinct_by_score", "H3_tier_reachable", "I2_home_totals", "I9_null_rates", "I13_score_histogram",
    "J4_monotonic_violations", "E1_school_row_errors", "F2_append_schools", "B1_header_rows", "M2_duplicate_rate",
    "H1_search_enriched", "G2_schools_by_rank", "D3_normalize_school", "B8_parse_school_sheets", "A4_page_links", "K1_clustered_rows",
)

SLOW = 15.0  # seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    builds = catalog.queries()
    wanted = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    builds["I3_rows_per_year"](spark, folder).collect()  # start the JVM and the readers
    times = {}
    for name in wanted:
        runs = []
        # One run to warm up, never counted; then the median of the repeats, or the next run alone for a slow query.
        for turn in range(repeats + 1):
            start = time.perf_counter()
            builds[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if turn:
                runs.append(took)
            if turn and took > SLOW:
                break
        times[name] = round(sorted(runs)[len(runs) // 2], 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
