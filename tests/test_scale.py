"""What must hold for large inputs: plans, and the folder for intermediate tables."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from salesmart import staging
from salesmart.checks.queries import QUERIES
from salesmart.config import COUNTRIES, INDIA
from salesmart.operators.anti import not_yet_in
from salesmart.operators.filters import settled, with_market
from salesmart.operators.sets import union_all
from salesmart.plans.curate import curate
from salesmart.plans.dimensions import PRODUCT
from salesmart.plans.fact import join_member, star_join, star_of
from salesmart.sources.testdata import exchange_rates, source_rows
from salesmart.staging import stage
from tests.samples import curated


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def india(spark, sf_dir):
    return stage(source_rows(spark, sf_dir, INDIA), "source")


def test_filters_and_columns_reach_the_scan(india):
    plan = plan_of(settled(india).select("ORDER_ID"))
    # the plan text is cut after the first letters of the second filter
    assert "EqualTo(PAYMENT_STATUS,Paid), EqualTo(SHI" in plan
    assert "CUSTOMER_NAME" not in plan


def test_curating_does_not_shuffle_or_sort_the_orders(spark, sf_dir, india):
    rates = stage(exchange_rates(spark, sf_dir), "rates")
    plan = plan_of(curate(india, INDIA, rates))
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_a_country_filter_drops_the_other_branches(india):
    both = union_all(*[with_market(india, c) for c in COUNTRIES])
    plan = plan_of(both.where("Country = 'France'"))
    assert plan.count("FileScan") == 1


def test_no_python_and_no_pairs_in_the_plans(spark, sf_dir):
    for name in ("sales_fact", "kpi_payment_mix", "fact_scd2_join", "anti_not_in_dates"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        for costly in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert costly not in plan, (name, costly)


@pytest.fixture
def shuffled_joins(spark):
    """Joins as they are for tables too large to broadcast, with a low bar for skew."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.files.maxPartitionBytes": "40k",
        "spark.sql.files.openCostInBytes": "0",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def skewed(spark, rows=60_000):
    """Sales of which a third have the same product, day and customer."""
    number = F.col("id")
    other = F.xxhash64("id")
    return stage(
        curated(spark, {})
        .drop("SALES_ORDER_KEY", "ORDER_ID", "MOBILE_KEY", "CUSTOMER_NAME", "ORDER_DT")
        .crossJoin(spark.range(0, rows, 1, 8))
        .withColumns(
            {
                "SALES_ORDER_KEY": number.cast("decimal(38,0)"),
                "ORDER_ID": F.concat(F.lit("O-"), number.cast("string")),
                "MOBILE_KEY": F.when(number % 3 == 0, "a/b/c/d").otherwise(
                    F.concat_ws("/", (other % 5000).cast("string"), F.lit("m"), F.lit("c"),
                                F.lit("8"))
                ),
                "CUSTOMER_NAME": F.when(number % 3 == 0, "Ann").otherwise(
                    (other % 7000).cast("string")
                ),
                "ORDER_DT": F.when(number % 3 == 0, F.lit(date(2020, 1, 1))).otherwise(
                    F.date_add(F.lit(date(2020, 1, 2)), (number % 300).cast("int"))
                ),
            }
        )
        .drop("id"),
        "skewed",
    )


def final_plan(df):
    df.collect()
    return plan_of(df)


def test_hot_product_and_customer_are_split(spark, shuffled_joins):
    sales = skewed(spark)
    star = star_of(sales)
    product = join_member(sales, star.product, PRODUCT).select("SALES_ORDER_KEY", PRODUCT.key)
    assert "skew=true" in final_plan(product)
    assert star_join(sales, star, grain_safe=True).count() == sales.count()


def test_hot_fact_rows_are_split_in_the_anti_join(spark, shuffled_joins):
    rows = skewed(spark).select("MOBILE_KEY", "SALES_ORDER_KEY", "CUSTOMER_NAME", "ORDER_ID")
    known = rows.where("MOBILE_KEY <> 'a/b/c/d'").select("MOBILE_KEY").limit(100)
    fresh = not_yet_in(rows, stage(known), ["MOBILE_KEY"], repeated=True)
    plan = final_plan(fresh)
    assert "skew=true" in plan
    seen = {r["MOBILE_KEY"] for r in known.collect()}
    assert fresh.count() == sum(r["MOBILE_KEY"] not in seen for r in rows.collect())


class OtherSession:
    """A session of a cluster, as far as the folder is concerned."""

    def __init__(self, master, folder):
        self.conf, self.sparkContext = self, self
        self.master, self.applicationId, self.folder = master, f"app-{master}", folder

    def get(self, name, default=None):
        assert name == "spark.checkpoint.dir"
        return self.folder or default


def test_shared_folder():
    assert staging.shared_folder(OtherSession("yarn", "/shared/x/")) == "/shared/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(OtherSession("yarn", None))
    assert staging.shared_folder(OtherSession("local[2]", None))
