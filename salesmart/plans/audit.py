"""All data-quality checks over a loaded warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.config import COUNTRIES
from salesmart.operators import quality
from salesmart.plans.curate import all_sales, sales_table
from salesmart.plans.dimensions import (
    CUSTOMER,
    DATE_KEY,
    PAYMENT,
    PRODUCT,
    PROMOTION,
    REGION,
)
from salesmart.plans.fact import Star, read_star
from salesmart.sources.rates import repeated_rate_dates
from salesmart.sources.warehouse import Warehouse


def references(star: Star) -> dict[str, tuple[DataFrame, str]]:
    """Each foreign key of the fact with the dimension and key it refers to."""
    return {
        "date_id_fk": (star.date, DATE_KEY),
        "region_id_fk": (star.region, REGION.key),
        "customer_id_fk": (star.customer, CUSTOMER.key),
        "payment_id_fk": (star.payment, PAYMENT.key),
        "product_id_fk": (star.product, PRODUCT.key),
        "promo_code_id_fk": (star.promotion, PROMOTION.key),
    }


def identified_by(star: Star) -> dict[str, tuple[DataFrame, str, tuple[str, ...]]]:
    """Each dimension with its key and the columns that identify a member."""
    return {
        "date": (star.date, DATE_KEY, ("order_dt",)),
        "region": (star.region, REGION.key, REGION.identity),
        "product": (star.product, PRODUCT.key, PRODUCT.identity),
        "promotion": (star.promotion, PROMOTION.key, PROMOTION.identity),
        "customer": (star.customer, CUSTOMER.key, CUSTOMER.identity),
        "payment": (star.payment, PAYMENT.key, PAYMENT.identity),
    }


def layer_counts(warehouse: Warehouse) -> DataFrame:
    """Rows per table from landing to fact; rejected rows are counted beside the loaded ones."""
    tables = {
        f"{layer}.{sales_table(c)}": warehouse.find(layer, sales_table(c))
        for layer in ("source", "rejects", "curated")
        for c in COUNTRIES
    }
    tables["common.rate_rejects"] = warehouse.find("common", "rate_rejects")
    tables["consumption.sales_fact"] = warehouse.find("consumption", "sales_fact")
    return quality.row_counts({name: df for name, df in tables.items() if df is not None})


def audit(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Findings by name. Sound data has zeros in all of them but the counts."""
    star = read_star(warehouse)
    fact = warehouse.read("consumption", "sales_fact")
    curated = all_sales(warehouse)
    return {
        "row counts": layer_counts(warehouse),
        "days with several rates": repeated_rate_dates(
            warehouse.read("common", "exchange_rate")
        ).agg(F.count(F.lit(1)).alias("n_days")),
        "currency conversion": quality.conversion_errors(curated),
        "missing values": quality.null_profile(
            curated, ["ORDER_ID", "ORDER_DT", "CUSTOMER_NAME", "MOBILE_KEY", "EXCHANGE_RATE"]
        ),
        "value ranges": quality.out_of_range(
            curated,
            {
                "quantity is positive": F.col("ORDER_QUANTITY") > 0,
                "amount is not negative": F.col("LOCAL_TOTAL_ORDER_AMT") >= 0,
                "rate is positive": F.col("EXCHANGE_RATE") > 0,
            },
        ),
        "repeated dimension members": quality.duplicate_members(identified_by(star)),
        "repeated fact keys": quality.repeated(fact, ["order_id_pk"]),
        "fact rows without a dimension member": quality.orphans(fact, references(star)),
    }
