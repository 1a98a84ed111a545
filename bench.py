"""Time the load of the star schema and the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores;
BENCH_ONLY is an optional comma-separated list of query names. Every query runs to completion with all
its columns (no-op sink) and is timed on its second run; ``cold_total`` sums the first runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tarmac import registry  # noqa: E402
from tarmac.plans import views  # noqa: E402
from tarmac.session import local_session  # noqa: E402
from tarmac.testbed import Testbed, testbed  # noqa: E402

HEADLINE = [
    *views.VIEWS,
    "fact_flights", "fact_summary", "integrity_report", "profile_columns", "bad_rows", "unmapped_codes",
    "dim_summary", "ex_avg_delay_by_airline", "ex_weather_by_season", "eda_airline_stats", "eda_delay_histogram",
    "eda_delay_exp_fit", "eda_airport_carrier_pivot", "eda_route_delay", "eda_time_of_day", "eda_quadratic_fit",
    "ml_mean_delay_by_time", "ml_linear_fit", "ml_poly_fit", "ml_poly_cv", "ml_dep_arr_features",
    "ml_ols_all_airports", "ml_model3", "ml_split_bias", "ingest_batches",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]

    bed = testbed(spark, sf_dir)
    seconds = {"stage_flights": timed(lambda: bed.flights), "load_star": timed(lambda: bed.star)}
    # The same load again, into a new warehouse, without the cost of a cold JVM.
    again = Testbed(spark, sf_dir)
    seconds["stage_flights_warm"] = timed(lambda: again.flights)
    seconds["load_star_warm"] = timed(lambda: again.star)

    queries = registry.queries()
    cold = 0.0
    for name in only or HEADLINE:
        cold += timed(lambda: run(queries[name](spark, sf_dir)))
        seconds[name] = timed(lambda: run(queries[name](spark, sf_dir)))
    warm = {name: s for name, s in seconds.items() if not name.startswith(("stage_flights", "load_star"))}
    print(
        json.dumps(
            {
                "metric": "headline query time, total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold_total": round(cold, 3),
                "slowest": max(warm, key=warm.get),
                "rows": bed.star.fact.count(),
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
