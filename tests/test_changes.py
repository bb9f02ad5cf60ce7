"""Builds that follow what has changed, refreshes that fail, and the months they go by."""

from __future__ import annotations

import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart import files
from salesmart.config import FRANCE, INDIA, USA
from salesmart.functions.dates import days_in, in_months, months_of
from salesmart.operators import sinks
from salesmart.plans import build, changes, kpi
from salesmart.plans.build import build_warehouse
from salesmart.plans.dimensions import HISTORY_TABLE, load_dimensions
from salesmart.plans.fact import load_fact, read_star, refresh_fact
from salesmart.sources.warehouse import Warehouse
from tests.samples import csv_line, curated, values
from tests.test_ingest import lines, put

RATES = "DATE,USD2USD,USD2EU,USD2INR\n"


class Shop:
    """Landing files and rates of a few hand-made orders."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.warehouse = Warehouse(spark, f"{folder}/warehouse")
        self.rates({"2020-01-31": 70, "2020-02-01": 71, "2021-05-05": 72})

    def rates(self, rupees):
        text = RATES + "".join(f"{day},1,0.9,{rate}\n" for day, rate in rupees.items())
        (self.folder / "rates.csv").write_text(text)

    def india(self, name, *orders, at=None):
        """Orders as (id, day, quantity); ``at`` is the file's modification time."""
        put(self.folder / "landing", INDIA, name, lines(*[
            csv_line(**{"Order ID": o, "Order Date": d, "Quantity": str(q)}) for o, d, q in orders
        ]))
        if at:
            path = self.folder / "landing" / INDIA.directory / name
            os.utime(path, (at, at))

    def build(self, **options):
        build_warehouse(self.warehouse, f"{self.folder}/landing", f"{self.folder}/rates.csv", **options)

    def fact(self):
        rows = self.warehouse.read("consumption", "sales_fact")
        return values(rows, "order_code", "order_quantity", "order_id_pk")


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, tmp_path)


def test_a_build_with_nothing_new_reads_no_sales(shop, monkeypatch):
    shop.india("a.csv", ("O-1", "2020-01-31", 1))
    shop.build()
    before = shop.fact()

    def unwanted(*_, **__):
        raise AssertionError("sales were read")

    for name in ("curate_months", "all_sales", "load_dimensions", "refresh_fact"):
        monkeypatch.setattr(build, name, unwanted)
    monkeypatch.setattr(changes, "settled", unwanted)
    shop.build()
    assert shop.fact() == before == [("O-1", 1, 1)]


def test_a_newer_file_takes_the_place_of_its_days_and_keys_stay(shop):
    shop.india("a.csv", ("O-1", "2020-01-31", 1), ("O-2", "2020-02-01", 2), at=1_600_000_000)
    shop.build()
    first = {code: key for code, _, key in shop.fact()}
    shop.india("b.csv", ("O-3", "2020-01-31", 3), ("O-4", "2021-05-05", 4), at=1_600_000_100)
    shop.build()
    found = {code: (quantity, key) for code, quantity, key in shop.fact()}
    assert {c: q for c, (q, _) in found.items()} == {"O-2": 2, "O-3": 3, "O-4": 4}
    assert found["O-2"][1] == first["O-2"]
    assert {found["O-3"][1], found["O-4"][1]} == {3, 4}


def test_only_touched_months_are_written(shop):
    shop.india("a.csv", ("O-1", "2020-01-31", 1), ("O-2", "2020-02-01", 2))
    shop.build()

    def written(layer, name):
        rows = shop.warehouse.read(layer, name)
        found = rows.select("order_month", F.col("_metadata.file_name")).collect()
        return {r["order_month"]: r["file_name"] for r in found}

    tables = (("curated", "in_sales_order"), ("consumption", "sales_fact"))
    before = {t: written(*t) for t in tables}
    shop.india("b.csv", ("O-3", "2020-02-01", 3))
    shop.build()
    for table in tables:
        after = written(*table)
        assert after[1] == before[table][1] and after[2] != before[table][2]


def test_a_changed_rate_reprices_its_month(shop):
    shop.india("a.csv", ("O-1", "2020-01-31", 1), ("O-2", "2020-02-01", 2))
    shop.build()
    keys = {code: key for code, _, key in shop.fact()}
    shop.rates({"2020-01-31": 35, "2020-02-01": 71})
    shop.build()
    dollars = values(shop.warehouse.read("consumption", "sales_fact"), "order_code", "exchange_rate")
    assert [(c, int(r)) for c, r in dollars] == [("O-1", 35), ("O-2", 71)]
    assert {code: key for code, _, key in shop.fact()} == keys


@pytest.mark.parametrize("stops", ["curate_months", "load_dimensions", "refresh_fact", "note_applied"])
def test_a_build_that_fails_is_done_again(shop, monkeypatch, stops):
    shop.india("a.csv", ("O-1", "2020-01-31", 1))
    shop.build()
    shop.india("b.csv", ("O-2", "2020-02-01", 2))

    def fails(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(build, stops, fails)
        with pytest.raises(RuntimeError, match="lost"):
            shop.build()
    shop.build()
    found = shop.fact()
    assert [(c, q) for c, q, _ in found] == [("O-1", 1), ("O-2", 2)]
    assert len({key for *_, key in found}) == 2


def test_one_source_alone(shop):
    shop.india("a.csv", ("O-1", "2020-01-31", 1))
    shop.build()
    assert shop.warehouse.find("source", "us_sales_order") is None
    assert len(shop.fact()) == 1


def test_sales_without_a_day_are_a_month_of_their_own(shop):
    shop.india("a.csv", ("O-1", "2020-01-31", 1), ("O-2", "", 2))
    shop.build()
    shop.india("b.csv", ("O-3", "", 3))
    shop.build()
    curated_rows = shop.warehouse.read("curated", "in_sales_order")
    assert values(curated_rows, "ORDER_ID") == [("O-1",), ("O-3",)]
    assert [c for c, *_ in shop.fact()] == ["O-1"]


def test_history_is_kept_by_the_build(shop):
    shop.india("a.csv", ("O-1", "2020-01-31", 1))
    shop.build(as_of=date(2020, 2, 1))
    changed = csv_line(**{"Order ID": "O-2", "Order Date": "2020-02-01", "Phone": "2"})
    put(shop.folder / "landing", INDIA, "b.csv", lines(changed))
    shop.build(as_of=date(2020, 3, 1))
    history = shop.warehouse.read("consumption", HISTORY_TABLE)
    assert values(history, "contact_no", "isActive") == [("1", "N"), ("2", "Y")]


def test_equal_lines_and_lines_without_a_code_are_known_by_their_load_key(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    same = [{"ORDER_ID": None, "SALES_ORDER_KEY": Decimal(1)}, {"ORDER_ID": "O", "SALES_ORDER_KEY": Decimal(2)}]
    later = [*same, {"ORDER_ID": "O", "SALES_ORDER_KEY": Decimal(3)}]
    load_dimensions(warehouse, curated(spark, *later))
    for rows, expected in ((same, 2), (same, 2), (later, 3), (later, 3)):
        load_fact(warehouse, curated(spark, *rows))
        fact = warehouse.read("consumption", "sales_fact")
        assert sorted(k for k, in values(fact, "order_id_pk")) == list(range(1, expected + 1))
    refresh_fact(warehouse, curated(spark, *later[1:]), frozenset({(2020, 1)}))
    fact = warehouse.read("consumption", "sales_fact")
    assert values(fact, "order_id_pk", "sales_order_key") == [(2, 2), (3, 3)]


# ---- Tables ----


def test_a_refresh_that_fails_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    sinks.replace_rows(spark.range(3), path)
    reader = sinks.read_if_present(spark, path)

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "switch", fails)
        with pytest.raises(RuntimeError, match="lost"):
            sinks.replace_rows(spark.range(9), path)
    assert sinks.read_if_present(spark, path).count() == 3
    bad = spark.range(4).select((F.col("id") / F.when(F.col("id") < 3, 1).otherwise(0)).alias("id"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.replace_rows(bad, path)
    assert sinks.read_if_present(spark, path).count() == 3
    # a frame that reads the table replaces it, and a reader from before still finds its rows
    sinks.replace_rows(reader.where("id > 0"), path)
    assert values(sinks.read_if_present(spark, path), "id") == [(1,), (2,)]
    assert reader.count() == 3
    sinks.replace_rows(spark.range(1), path)
    assert len([n for n in files.children(spark, path) if n.startswith(sinks.VERSION)]) == 2


def test_small_files_are_put_in_place_as_a_whole(spark, tmp_path):
    path = f"{tmp_path}/deep/note"
    assert files.read_text(spark, path) is None and files.children(spark, f"{tmp_path}/deep") == []
    for text in ("one", "zwei ü"):
        files.write_text(spark, path, text)
        assert files.read_text(spark, path) == text
    assert files.children(spark, f"{tmp_path}/deep") == ["note"]
    files.delete(spark, path)
    assert not files.exists(spark, path)


def test_other_partitions_stay(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, None)], "v int, p int")
    sinks.replace_partitions(rows, path, ["p"])
    sinks.replace_partitions(spark.createDataFrame([(9, 1), (8, None), (7, 3)], "v int, p int"), path, ["p"])
    assert values(sinks.read_if_present(spark, path), "p", "v") == [(None, 8), (1, 9), (2, 3), (3, 7)]


# ---- Months ----


def test_months(spark):
    days = ["2019-12-31", "2020-01-01", "2020-02-29", "2020-03-01", "2020-12-31", "2021-01-01", None]
    rows = spark.createDataFrame([(d and date.fromisoformat(d),) for d in days], "ORDER_DT date").withColumns(
        {"y": F.year("ORDER_DT"), "m": F.month("ORDER_DT")}
    )
    assert months_of(rows) == {(2019, 12), (2020, 1), (2020, 2), (2020, 3), (2020, 12), (2021, 1), (None, None)}
    for months in (set(), {(2020, 1), (2020, 2)}, {(2020, 12)}, {(None, None), (2021, 1)}, {(2020, 2), (2020, 12)}):
        wanted = frozenset(months)
        expected = sorted(str(d) for d in days if (tuple(map(int, d.split("-")[:2])) if d else (None, None)) in wanted)
        for condition in (days_in(wanted), in_months(wanted, "y", "m")):
            assert sorted(str(r["ORDER_DT"]) for r in rows.where(condition).collect()) == expected


def test_dashboard_filters_choose_partitions(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    days = [date(2020, m, 3) for m in range(1, 13)] + [date(2021, m, 3) for m in range(1, 13)]
    sales = curated(spark, *[
        {"ORDER_DT": d, "ORDER_YEAR": d.year, "ORDER_MONTH": d.month} for d in days
    ])
    load_dimensions(warehouse, sales)
    load_fact(warehouse, sales)
    fact, star = warehouse.read("consumption", "sales_fact"), read_star(warehouse)

    def files_read(chosen):
        rows = kpi.select_sales(fact, star, chosen)
        rows.collect()
        node = rows._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in node.splitlines() if "PartitionFilters" in line and "order_quantity" in line]
        assert scans and any("PartitionFilters: [isnotnull" in s or "dynamicpruning" in s for s in scans), node
        return rows.count()

    assert files_read(kpi.Selection(year=2021)) == 12
    assert files_read(kpi.Selection(first_day=date(2020, 11, 1), last_day=date(2021, 2, 28))) == 4
    metrics = kpi.select_sales(
        fact, star, kpi.Selection(first_day=date(2020, 11, 1), last_day=date(2021, 2, 28))
    )
    assert "dynamicpruning" in metrics._jdf.queryExecution().executedPlan().toString()


def test_source_names_are_the_same_in_every_layer():
    assert [changes.sales_table(c) for c in (INDIA, USA, FRANCE)] == [
        "in_sales_order", "us_sales_order", "fr_sales_order",
    ]
