"""The whole warehouse from landing files, twice."""

from __future__ import annotations

from datetime import date

from salesmart import staging
from salesmart.__main__ import run
from salesmart.config import COUNTRIES
from salesmart.plans import kpi
from salesmart.plans.audit import audit
from salesmart.plans.build import build_warehouse
from salesmart.plans.dimensions import load_customer_history
from salesmart.plans.fact import read_star
from salesmart.sources.testdata import (
    exchange_rates,
    landing_text,
    write_landing,
    write_rates,
)
from salesmart.sources.warehouse import Warehouse
from tests.samples import curated, values

# The landing text carries no file times of the past, so all Indian rows of a day tie.
TABLES = ("region_dim", "product_dim", "promo_code_dim", "customer_dim", "payment_dim",
          "date_dim", "sales_fact")


def test_build_and_rebuild(spark, sf_dir, tmp_path, capsys):
    landing, rates = f"{tmp_path}/landing", f"{tmp_path}/rates"
    for country in COUNTRIES:
        write_landing(landing_text(spark, sf_dir, country), landing, country)
    write_rates(exchange_rates(spark, sf_dir), rates)
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")

    def sizes():
        return {t: warehouse.read("consumption", t).count() for t in TABLES}

    build_warehouse(warehouse, landing, rates)
    source = {c.code: warehouse.read("source", f"{c.code.lower()}_sales_order").count()
              for c in COUNTRIES}
    assert source == {"IN": 2417, "US": 1343, "FR": 2240}
    curated = sum(warehouse.read("curated", f"{c.code.lower()}_sales_order").count()
                  for c in COUNTRIES)
    first = sizes()
    assert first["sales_fact"] == curated
    assert first["region_dim"] == 3 and first["payment_dim"] == 75
    fact = warehouse.read("consumption", "sales_fact")
    revenue = kpi.revenue_by_country(fact, read_star(warehouse))
    assert {r["Country"] for r in revenue.collect()} == {"India", "USA", "France"}

    found = audit(warehouse)
    assert found["days with several rates"].first()[0] == 0
    assert found["repeated fact keys"].first()[0] == 0
    assert sum(r["n_orphans"] for r in found["fact rows without a dimension member"].collect()) == 0
    assert sum(r["n_repeated"] for r in found["repeated dimension members"].collect()) == 0
    assert sum(r["n_wrong"] for r in found["currency conversion"].collect()) == 0
    assert sum(r["n_nulls"] for r in found["missing values"].collect()) == 0
    assert sum(r["n_broken"] for r in found["value ranges"].collect()) == 0

    build_warehouse(warehouse, landing, rates)
    assert sizes() == first

    warehouse.publish("consumption", "sales_fact", "region_dim")
    asked = spark.sql(
        "SELECT Country, count(*) AS n FROM consumption.sales_fact JOIN consumption.region_dim"
        " ON region_id_fk = region_id_pk GROUP BY Country"
    )
    assert sum(r["n"] for r in asked.collect()) == first["sales_fact"]

    at = ["--warehouse", warehouse.root]
    run(["build", *at, "--landing", landing, "--rates", rates], spark)
    assert sizes() == first
    run(["audit", *at], spark)
    run(["report", *at, "--country", "India", "--year", "1997"], spark)
    run(["sql", *at, "SELECT count(*) AS regions FROM consumption.region_dim"], spark)
    printed = capsys.readouterr().out
    for heading in ("repeated fact keys", "revenue_usd", "promotion_code", "regions"):
        assert heading in printed


def test_customer_history_grows_with_the_loads(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    one, two = curated(spark, {}), curated(spark, {"CONTACT_NO": "2"})
    for sales, day in ((one, date(2020, 1, 1)), (one, date(2020, 2, 1)), (two, date(2020, 3, 1))):
        load_customer_history(warehouse, sales, day)
    history = warehouse.read("consumption", "customer_history")
    assert values(history, "contact_no", "valid_from", "isActive") == [
        ("1", date(1900, 1, 1), "N"), ("2", date(2020, 3, 1), "Y"),
    ]


def test_intermediate_tables_can_be_dropped(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    staged = staging.stage(spark.range(3))
    assert staged.count() == 3 and list(tmp_path.rglob("*.parquet"))
    staging.drop_intermediate(spark)
    assert not list(tmp_path.rglob("*.parquet"))
