"""CURATED to dimensions: new members get a key, known ones are left alone."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.config import ACTIVE
from salesmart.functions.columns import find_column, resolve_columns, with_promotion
from salesmart.functions.text import mobile_key_parts
from salesmart.operators.anti import not_in, not_yet_in
from salesmart.operators.calendar import calendar
from salesmart.operators.history import first_versions, latest_state, merge_versions
from salesmart.operators.keys import next_key, number_by_range
from salesmart.operators.sinks import append_or_recreate
from salesmart.sources.warehouse import Warehouse
from salesmart.staging import side_by_side, stage


@dataclass(frozen=True)
class Dimension:
    """A dimension: its table, its key, and the columns that identify a member.

    ``recreated`` says that a table lacking one of these columns is started anew; the others'
    tables hold keys that the fact refers to, and are refused then.
    """

    table: str
    key: str
    identity: tuple[str, ...]
    recreated: bool = False


# ---- Fixed values: the dimensions and their layouts ----
REGION = Dimension("region_dim", "region_id_pk", ("Country", "Region"))
PRODUCT = Dimension(
    "product_dim", "product_id_pk", ("mobile_key", "Brand", "Model", "Color", "Memory")
)
PROMOTION = Dimension(
    "promo_code_dim", "promo_code_id_pk", ("promotion_code", "country", "region"), recreated=True
)
CUSTOMER = Dimension(
    "customer_dim",
    "customer_id_pk",
    ("customer_name", "contact_no", "shipping_address", "country", "region"),
)
PAYMENT = Dimension(
    "payment_dim",
    "payment_id_pk",
    ("payment_method", "payment_provider", "country", "region"),
)
DIMENSIONS = (REGION, PRODUCT, PROMOTION, CUSTOMER, PAYMENT)
DATE_TABLE, DATE_KEY = "date_dim", "date_id_pk"
HISTORY_TABLE = "customer_history"


def identities(sales: DataFrame, dimension: Dimension) -> DataFrame:
    """The identifying columns of every sale."""
    if dimension is PROMOTION:
        sales = with_promotion(sales)
    if dimension is PRODUCT:
        parts = mobile_key_parts(F.col("mobile_key"))
        return resolve_columns(sales, ["mobile_key"]).select(
            "mobile_key", *[part.alias(name) for name, part in parts.items()]
        )
    return resolve_columns(sales, dimension.identity)


def members(sales: DataFrame, dimension: Dimension) -> DataFrame:
    """The distinct members that occur in the sales, combined before the shuffle.

    The parts of a product follow from its name, which is taken apart once for each product.
    """
    if dimension is PRODUCT:
        return identities(resolve_columns(sales, ["mobile_key"]).distinct(), dimension)
    return identities(sales, dimension).distinct()


def member_counts(sales: DataFrame, dimension: Dimension) -> DataFrame:
    """The same with the number of sales of each member."""
    return (
        identities(sales, dimension)
        .groupBy(*dimension.identity)
        .agg(F.count(F.lit(1)).alias("n_sales"))
    )


def new_members(
    sales: DataFrame,
    dimension: Dimension,
    existing: DataFrame | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Members that the existing dimension lacks, without keys."""
    found = members(sales, dimension)
    if existing is None:
        return found
    theirs = {name: find_column(existing, name) for name in dimension.identity}
    if None in theirs.values():
        return found
    return not_yet_in(found, existing, theirs, null_safe)


def dimension_rows(
    sales: DataFrame,
    dimension: Dimension,
    existing: DataFrame | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """The rows to add to a dimension: key, identity and the active flag."""
    usable = existing
    if existing is not None and find_column(existing, dimension.key) is None:
        usable = None
    start = next_key(usable, dimension.key)
    fresh = new_members(sales, dimension, existing, null_safe)
    keyed = number_by_range(fresh, dimension.identity, dimension.key, start)
    return keyed.withColumn("isActive", F.lit(ACTIVE))


def date_rows(sales: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The calendar days to add: those between the first and the last day of these sales and of
    the existing days. The day counter counts from the first of them."""
    days = sales.select(F.col("ORDER_DT").alias("ORDER_DT"))
    if existing is None:
        spine = calendar(days)
    else:
        known = existing.select(F.col("order_dt").alias("ORDER_DT"))
        spine = not_in(calendar(days.unionByName(known)), "order_dt", existing, "order_dt")
    return number_by_range(spine, ["order_dt"], DATE_KEY, next_key(existing, DATE_KEY))


def load_dimensions(warehouse: Warehouse, sales: DataFrame, null_safe: bool = False) -> None:
    """Add what is new to all dimensions; a second run over the same sales adds nothing.

    New rows are written before they are appended, so every plan runs once. The dimensions do
    not depend on each other and are loaded at the same time.
    """

    def load_days() -> None:
        rows = stage(date_rows(sales, warehouse.find("consumption", DATE_TABLE)), DATE_TABLE)
        warehouse.append("consumption", DATE_TABLE, rows)

    def load(dimension: Dimension) -> None:
        existing = warehouse.find("consumption", dimension.table)
        if existing is not None and not dimension.recreated:
            resolve_columns(existing, (dimension.key, *dimension.identity))
        rows = stage(dimension_rows(sales, dimension, existing, null_safe), dimension.table)
        path = warehouse.path("consumption", dimension.table)
        append_or_recreate(rows, path, dimension.identity)

    side_by_side(load_days, *[lambda d=d: load(d) for d in DIMENSIONS])


def load_customer_history(
    warehouse: Warehouse, sales: DataFrame, as_of: date, since: date = date(1900, 1, 1)
) -> None:
    """Bring the versions of the customers up to the state these sales show.

    The first load dates its versions ``since``; each later one ends the versions that
    changed on ``as_of``.
    """
    state = latest_state(sales)
    history = warehouse.find("consumption", HISTORY_TABLE)
    if history is None:
        warehouse.replace("consumption", HISTORY_TABLE, first_versions(state, since))
        return
    merged = merge_versions(history, state, as_of)
    warehouse.replace("consumption", HISTORY_TABLE, merged)
