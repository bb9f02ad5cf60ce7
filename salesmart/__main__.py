"""Run the jobs: ``spark-submit`` this package, or ``python -m salesmart``.

    python -m salesmart build  --warehouse W --landing L --rates R [--as-of 2024-01-31]
    python -m salesmart compact --warehouse W
    python -m salesmart audit  --warehouse W
    python -m salesmart report --warehouse W [--country India] [--year 2020]
    python -m salesmart sql    --warehouse W "SELECT * FROM consumption.region_dim"

``build`` loads what is new in the landing area and brings every layer up to date; ``compact``,
run between builds, packs the files of many small loads into fewer; ``audit`` prints the quality checks, ``report`` the dashboard figures, ``sql`` the result of a query.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import SparkSession

from salesmart.config import COUNTRIES
from salesmart.plans import kpi
from salesmart.plans.audit import audit, layer_counts
from salesmart.plans.build import build_warehouse
from salesmart.plans.curate import sales_table
from salesmart.plans.dimensions import DATE_TABLE, DIMENSIONS, HISTORY_TABLE
from salesmart.plans.fact import read_star
from salesmart.plans.upkeep import compact_sources
from salesmart.sources.warehouse import Warehouse
from salesmart.staging import drop_intermediate


def build(warehouse: Warehouse, options: argparse.Namespace) -> None:
    build_warehouse(
        warehouse,
        options.landing,
        options.rates,
        grain_safe=not options.customers_by_name,
        as_of=options.as_of,
    )
    layer_counts(warehouse).show(truncate=False)


def compact(warehouse: Warehouse, options: argparse.Namespace) -> None:
    compact_sources(warehouse)


def check(warehouse: Warehouse, options: argparse.Namespace) -> None:
    for name, findings in audit(warehouse).items():
        print(name)
        findings.show(truncate=False)


def sql(warehouse: Warehouse, options: argparse.Namespace) -> None:
    sales = [sales_table(c) for c in COUNTRIES]
    warehouse.publish("common", "exchange_rate", "rate_rejects")
    warehouse.publish("source", *sales)
    warehouse.publish("curated", *sales)
    warehouse.publish(
        "consumption", DATE_TABLE, *[d.table for d in DIMENSIONS], HISTORY_TABLE, "sales_fact"
    )
    warehouse.spark.sql(options.query).show(options.rows, truncate=False)


def report(warehouse: Warehouse, options: argparse.Namespace) -> None:
    star = read_star(warehouse)
    chosen = kpi.Selection(
        tuple(options.country or ()), options.year, options.first_day, options.last_day
    )
    fact = warehouse.read("consumption", "sales_fact")
    rows = kpi.select_sales(fact, star, chosen).select(*fact.columns)
    kpi.total_revenue(rows).show()
    kpi.revenue_by_country(rows, star).orderBy("Country").show()
    kpi.daily_trend(rows, star).orderBy("order_dt").show()
    kpi.promotion_usage(rows, star).orderBy("promotion_code", "order_dt").show()
    kpi.payment_mix(rows, star).orderBy("payment_method").show()


def run(arguments: list[str], spark: SparkSession) -> None:
    """Carry out one command."""
    parser = argparse.ArgumentParser(prog="salesmart", description=__doc__)
    commands = parser.add_subparsers(required=True)
    builder = commands.add_parser("build")
    builder.add_argument("--landing", required=True)
    builder.add_argument("--rates", required=True)
    builder.add_argument("--customers-by-name", action="store_true")
    builder.add_argument("--as-of", type=date.fromisoformat, help="keep the customers' history")
    builder.set_defaults(run=build)
    reporter = commands.add_parser("report")
    reporter.add_argument("--country", action="append")
    reporter.add_argument("--year", type=int)
    reporter.add_argument("--first-day", type=date.fromisoformat)
    reporter.add_argument("--last-day", type=date.fromisoformat)
    reporter.set_defaults(run=report)
    packer = commands.add_parser("compact")
    packer.set_defaults(run=compact)
    auditor = commands.add_parser("audit")
    auditor.set_defaults(run=check)
    asker = commands.add_parser("sql")
    asker.add_argument("query")
    asker.add_argument("--rows", type=int, default=20, help="how many result rows to print")
    asker.set_defaults(run=sql)
    for command in (builder, packer, reporter, auditor, asker):
        command.add_argument("--warehouse", required=True)
    options = parser.parse_args(arguments)
    options.run(Warehouse(spark, options.warehouse), options)


def main() -> None:
    spark = SparkSession.builder.appName("salesmart").getOrCreate()
    run(sys.argv[1:], spark)
    drop_intermediate(spark)
    spark.stop()


if __name__ == "__main__":
    main()
