"""Every registered query against its SQL, and the golden counts."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from salesmart.checks.oracle import ORACLE
from salesmart.checks.queries import QUERIES
from tests.oracle import connect, difference

@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_contract(spark):
    assert set(contract.queries()) >= set(QUERIES)
    assert set(contract.oracle_sql()) >= set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    result = contract.entry(spark)
    revenue = {r["country"]: round(r["revenue_usd"], 2) for r in result.collect()}
    # ---- Fixed values: golden revenue of the smallest tables ----
    assert revenue == {"India": 278495.75, "USA": 23741653.77, "France": 43526543.45}


def test_golden_counts(spark, sf_dir):
    # ---- Fixed values: golden counts of the smallest tables ----
    expected = {
        "source IN": 2417, "source US": 1343, "source FR": 2240,
        "curated IN": 419, "curated US": 472, "curated FR": 757,
        "curated": 1648, "fact": 1648, "fact by customer name": 3252,
    }
    counts = QUERIES["dq_row_counts"](spark, sf_dir).collect()
    assert {r["table_name"]: r["n_rows"] for r in counts} == expected


@pytest.mark.parametrize(
    "name, rows",
    [("dim_region", 3), ("dim_promo_code", 27), ("dim_payment", 75), ("dim_product", 200),
     ("dim_customer", 292), ("dim_date", 2403), ("scan_project_fx", 1094)],
)
def test_golden_sizes(spark, sf_dir, name, rows):
    assert QUERIES[name](spark, sf_dir).count() == rows
