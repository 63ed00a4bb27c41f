"""Wall time of the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "e02_surrogate_or_unknown", "e03_anti_join_new_rows", "e09_star_join", "f01_first_known_value", "f05_store_features",
    "f12_control_totals", "f17_describe_sales", "f18_quality_summary", "f21_product_hierarchy", "g01_sequential_key",
    "g03_first_row_per_key", "k03_sales_prior_period", "k07_sales_share", "l01_kpi_cards", "l04_sales_and_prior_by_month",
    "l05_yearly_kpi", "l08_product_drill", "l09_by_place", "l12_by_pharmacy", "l18_segment_table", "l21_district_view",
    "m02_z_scores", "m08_output_table", "n05_null_count_report", "n07_orphan_report", "o02_incremental_load",
    "o06_dim_product", "o07_fact_builder", "p01_file_arrivals",
)


def main() -> None:
    from salesmart.catalog import load
    from salesmart.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "salesmart-bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total wall time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"), "cpus": cores,
        "spark": spark.version, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
