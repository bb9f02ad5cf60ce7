"""Time the headline queries and a full warehouse build; prints one JSON line.

    BENCH_SF_DIR   folder of the input tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_QUERIES  comma-separated query names, or "all" (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import time

from salesmart.checks.queries import QUERIES
from salesmart.config import COUNTRIES
from salesmart.plans.build import build_warehouse
from salesmart.session import local_session
from salesmart.sources.testdata import (
    exchange_rates,
    landing_text,
    write_landing,
    write_rates,
)
from salesmart.sources.warehouse import Warehouse
from salesmart.staging import drop_intermediate, scratch_path

HEADLINE = (
    "ingest_csv", "ingest_parquet", "ingest_json",
    "filter_paid_delivered", "fx_convert", "conform_sales",
    "dedup_latest_file", "dedup_latest_per_order",
    "curated_in", "curated_us", "curated_fr", "union_distinct_sales",
    "dim_region", "dim_product", "dim_promo_code", "dim_customer", "dim_payment", "dim_date",
    "anti_new_customer", "key_grouped_offset", "assign_load_key",
    "sales_fact", "sales_fact_grain_safe", "fact_new_rows", "scd2_customer", "fact_scd2_join",
    "kpi_total_revenue", "kpi_revenue_by_country", "kpi_daily_trend", "kpi_promo_usage",
    "kpi_payment_mix", "kpi_filtered",
    "dq_fk_orphans", "dq_row_counts",
)


def seconds(run) -> float:
    begin = time.perf_counter()
    run()
    return round(time.perf_counter() - begin, 3)


def execute(df) -> None:
    """Compute every row and column, without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    execute(QUERIES["filter_paid_delivered"](spark, sf_dir))  # start the JVM's engine

    times = {name: seconds(lambda n=name: execute(QUERIES[n](spark, sf_dir))) for name in names}

    # The reference figure is a whole run, from landing files to the fact.
    landing, rates = scratch_path(spark, "landing"), scratch_path(spark, "rates")
    for country in COUNTRIES:
        write_landing(landing_text(spark, sf_dir, country), landing, country)
    write_rates(exchange_rates(spark, sf_dir), rates)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    times["warehouse_build"] = seconds(lambda: build_warehouse(warehouse, landing, rates))
    source_rows = sum(
        warehouse.read("source", f"{c.code.lower()}_sales_order").count() for c in COUNTRIES
    )
    times["warehouse_rebuild"] = seconds(lambda: build_warehouse(warehouse, landing, rates))

    print(
        json.dumps(
            {
                "metric": "total time of headline queries and warehouse builds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "warehouse_source_rows": source_rows,
                "warehouse_source_rows_per_sec": round(source_rows / times["warehouse_build"]),
            }
        ),
        flush=True,
    )
    drop_intermediate(spark)
    spark.stop()


if __name__ == "__main__":
    main()
