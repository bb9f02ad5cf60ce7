"""The sales fact: curated sales with the keys of six dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.config import FACT_COLUMNS, FACT_PARTITION, FACT_SOURCES
from salesmart.functions.columns import resolve_columns, with_promotion
from salesmart.functions.dates import Months, in_months
from salesmart.operators.anti import not_yet_in
from salesmart.operators.keys import next_key, number_dense, number_written, stage_numbered
from salesmart.plans.dimensions import (
    CUSTOMER,
    DATE_KEY,
    DATE_TABLE,
    PAYMENT,
    PRODUCT,
    PROMOTION,
    REGION,
    Dimension,
    date_rows,
    dimension_rows,
    members,
)
from salesmart.sources.warehouse import Warehouse
from salesmart.staging import let_shuffles_go, side_by_side, stage

# ---- Fixed values: the columns on which sales meet each dimension ----
JOIN_COLUMNS = {
    REGION.table: ("country", "region"),
    PROMOTION.table: ("promotion_code", "country", "region"),
    PAYMENT.table: ("payment_method", "payment_provider", "country", "region"),
    PRODUCT.table: ("mobile_key",),
    CUSTOMER.table: ("customer_name", "region", "country"),
}
FACT_TABLE, FACT_KEY, LAST_KEY_TABLE = "sales_fact", "order_id_pk", "last_fact_key"
ORDER_LINE = "sales_order_key"
# A line of one country; with customers met by name it has a row for each of them.
FACT_IDENTITY = (ORDER_LINE, "region_id_fk", "customer_id_fk")
STORED = (*FACT_COLUMNS, ORDER_LINE, *FACT_PARTITION)


@dataclass(frozen=True)
class Star:
    """The six dimensions as tables."""

    date: DataFrame
    region: DataFrame
    product: DataFrame
    promotion: DataFrame
    customer: DataFrame
    payment: DataFrame


def read_star(warehouse: Warehouse) -> Star:
    """The dimensions of a warehouse."""
    return Star(
        *[
            warehouse.read("consumption", name)
            for name in (
                DATE_TABLE, REGION.table, PRODUCT.table, PROMOTION.table, CUSTOMER.table,
                PAYMENT.table,
            )
        ]
    )


def star_of(sales: DataFrame) -> Star:
    """The dimensions of the given sales alone, as tables. Pass a table scan."""
    days, *rows = side_by_side(
        lambda: stage(date_rows(sales), DATE_TABLE),
        *[
            lambda d=d: stage(dimension_rows(sales, d), d.table)
            for d in (REGION, PRODUCT, PROMOTION, CUSTOMER, PAYMENT)
        ],
    )
    return Star(days, *rows)


def join_dimension(
    sales: DataFrame, dimension: DataFrame, key: str, on: tuple[str, ...]
) -> DataFrame:
    """Inner join that adds only the dimension's key, so no column name clashes."""
    return sales.join(resolve_columns(dimension, [key, *on]), list(on))


def join_date(sales: DataFrame, date: DataFrame) -> DataFrame:
    return join_dimension(sales, date, DATE_KEY, ("order_dt",))


def join_member(sales: DataFrame, rows: DataFrame, dimension: Dimension) -> DataFrame:
    """Meet a dimension on the columns the fact uses for it."""
    return join_dimension(sales, rows, dimension.key, JOIN_COLUMNS[dimension.table])


def join_customer(sales: DataFrame, customer: DataFrame, grain_safe: bool) -> DataFrame:
    """Meet the customers by name and market, or on everything that identifies one.

    A customer has one row per contact and address. By name, a sale therefore comes out once
    for each of them; on all five columns it comes out once.
    """
    on = CUSTOMER.identity if grain_safe else JOIN_COLUMNS[CUSTOMER.table]
    return join_dimension(sales, customer, CUSTOMER.key, on)


def star_join(sales: DataFrame, star: Star, grain_safe: bool = False) -> DataFrame:
    """Sales with all six keys; a sale that misses a dimension or has a NULL key drops out.

    The small dimensions come first: their joins are broadcasts by size, and the text columns
    they replace are gone before products and customers shuffle the sales.
    """
    return join_customer(join_small_dimensions(sales, star), star.customer, grain_safe)


def join_small_dimensions(sales: DataFrame, star: Star) -> DataFrame:
    """Sales with all keys but the customer's."""
    sales = with_promotion(sales)
    sales = join_date(sales, star.date)
    sales = join_member(sales, star.payment, PAYMENT).drop("payment_method", "payment_provider")
    sales = join_member(sales, star.promotion, PROMOTION).drop("promotion_code")
    sales = join_member(sales, star.region, REGION)
    return join_member(sales, star.product, PRODUCT).drop("mobile_key")


def fact_projection(joined: DataFrame, *more: str) -> DataFrame:
    """The fact columns but its own key, after the order line they came from."""
    columns = [F.col(FACT_SOURCES.get(c, c)).alias(c) for c in FACT_COLUMNS if c != FACT_KEY]
    return joined.select(ORDER_LINE, *columns, *more)


def sales_fact(sales: DataFrame, star: Star, grain_safe: bool = False) -> DataFrame:
    """The fact rows of the given sales with their keys, from 1 up."""
    rows = fact_projection(star_join(sales, star, grain_safe))
    return number_dense(rows, FACT_KEY).select(*FACT_COLUMNS)


def new_fact_rows(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Fact rows of order lines that are not in the fact yet."""
    return not_yet_in(rows, existing, FACT_IDENTITY, null_safe=True, repeated=True)


def of_same_regions(sales: DataFrame, star: Star, existing: DataFrame) -> DataFrame:
    """The fact rows whose region the sales have too: no other row can hold one of their lines."""
    regions = join_member(members(sales, REGION), star.region, REGION).select(REGION.key)
    found = [r[REGION.key] for r in regions.distinct().collect()]
    return existing.where(F.col("region_id_fk").isin(found))


def stored_rows(sales: DataFrame, star: Star, grain_safe: bool) -> DataFrame:
    """What the fact table holds: the fact, the order line and the month of its partition."""
    return fact_projection(star_join(sales, star, grain_safe), *FACT_PARTITION)


def draw_keys(warehouse: Warehouse, fresh: DataFrame) -> DataFrame:
    """Number rows that ``stage_numbered`` wrote, after the last key of the fact.

    The keys are taken before the rows are written: a run that fails leaves a gap and repeats
    none. The last key is a table of one row, so drawing reads nothing of the fact.
    """
    taken = warehouse.find("common", LAST_KEY_TABLE)
    start = next_key(taken, FACT_KEY)
    if taken is None:
        start = next_key(warehouse.find("consumption", FACT_TABLE), FACT_KEY)
    last = fresh.agg((F.count(F.lit(1)) + F.lit(start - 1)).alias(FACT_KEY))
    warehouse.replace("common", LAST_KEY_TABLE, last)
    return number_written(fresh, FACT_KEY, start)


def load_fact(
    warehouse: Warehouse, sales: DataFrame, grain_safe: bool = True, only_new: bool = True
) -> None:
    """Add sales to the fact.

    An order line is known by its country and load key, so a re-run adds nothing, a line without
    an order code neither, and two equal lines are two rows whenever they are loaded.
    ``only_new=False`` appends whatever is passed, and ``grain_safe=False`` meets customers by
    name.
    """
    star = read_star(warehouse)
    rows = stored_rows(sales, star, grain_safe)
    existing = warehouse.find("consumption", FACT_TABLE)
    if only_new and existing is not None:
        rows = new_fact_rows(rows, of_same_regions(sales, star, existing))
    keyed = draw_keys(warehouse, stage_numbered(rows, "fact-rows"))
    if existing is None:
        warehouse.replace("consumption", FACT_TABLE, keyed.select(*STORED), FACT_PARTITION)
    else:
        warehouse.append("consumption", FACT_TABLE, keyed.select(*STORED), FACT_PARTITION)


def refresh_fact(
    warehouse: Warehouse, sales: DataFrame, months: Months, grain_safe: bool = True
) -> None:
    """Replace the given months of the fact by their sales, which must be all sales of them.

    A line that was in the fact before keeps its key, a line that is gone leaves it, and other
    months are not read. Repeating it after a failure gives the same rows.
    """
    rows = stored_rows(sales, read_star(warehouse), grain_safe)
    existing = warehouse.find("consumption", FACT_TABLE)
    if existing is None:
        keyed = draw_keys(warehouse, stage_numbered(rows, "fact-rows"))
        warehouse.replace("consumption", FACT_TABLE, keyed.select(*STORED), FACT_PARTITION)
        return
    before = existing.where(in_months(months, *FACT_PARTITION)).select(
        F.col(FACT_KEY), *[F.col(c).alias(f"_{c}") for c in FACT_IDENTITY]
    )
    same_line = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FACT_IDENTITY]
    matched = rows.join(before, same_line, "left").withColumn("_new", F.col(FACT_KEY).isNull())
    staged = stage_numbered(matched.select(*STORED, "_new"), "fact-rows", ["_new"])
    # Those of the star join, before the rows move once more to be written by month.
    let_shuffles_go(warehouse.spark)
    keyed = draw_keys(warehouse, staged.where("_new"))
    kept = staged.where("NOT _new")
    warehouse.replace_partitions(
        "consumption",
        FACT_TABLE,
        kept.select(*STORED).unionByName(keyed.select(*STORED)),
        FACT_PARTITION,
    )
