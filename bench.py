"""Time the headline queries; prints one JSON line.

Each query is built and run to completion into a sink that discards the rows,
once to warm up and then ``BENCH_RUNS`` times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from stratiform.plans import catalog

HEADLINE = (
    "gld_zone_daily",
    "gld_zone_monthly",
    "gld_daily",
    "gld_daily_metrics",
    "gld_monthly_metrics",
    "gld_passenger_metrics",
    "gld_monthly_dims",
    "gld_dimension_key",
    "gld_dimension_key_ranged",
    "slv_dedup",
    "slv_text_layer",
    "slv_enriched_trips",
    "slv_completeness",
    "snk_upsert",
    "slv_snapshot_diff",
    "rpt_od_pivot",
    "rpt_completeness_hist",
    "rpt_dashboard",
    "dq_suite",
    "dq_null_pct",
    "dsc_profile",
    "dsc_profile_documents",
    "dsc_exact_duplicates",
    "lay_column_stats",
    "lay_zorder",
    "lay_compact",
    "feat_fare_residual",
    "snk_copy_into",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    queries = catalog.queries()
    names = sys.argv[1:] or list(HEADLINE)
    if names == ["all"]:
        names = list(queries)
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 4)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
