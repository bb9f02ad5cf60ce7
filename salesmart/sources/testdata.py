"""The sales sources, derived from the order tables that the checks run on.

Lineitems with their order, customer, nation, market and part become sales order lines; each of
the five markets belongs to one of the sales sources. Every expression has the same value in other SQL
engines: money is multiplied as decimals, never as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.config import AMOUNT, COUNTRIES, RATE, RATE_FIELDS, WHOLE, WHOLE_AMOUNT, Country


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_key() -> Column:
    """A unique whole number per order line: its five identifying numbers side by side.

    Orders get 13 digits, parts 11, suppliers 10, line number 1 and quantity 2, so it stays
    unique and within 38 digits far beyond 100 TB.
    """
    shift = F.lit(10**12).cast("decimal(13,0)")
    order = F.col("l_orderkey").cast("decimal(13,0)") * shift * shift
    part = F.col("l_partkey").cast("decimal(11,0)") * F.lit(10**13).cast("decimal(14,0)")
    rest = F.col("l_suppkey") * 1000 + F.col("l_linenumber") * 100 + F.col("l_quantity").cast(
        "bigint"
    )
    return order.cast(WHOLE) + part.cast(WHOLE) + rest.cast(WHOLE)


def _money(column: str) -> Column:
    return F.col(column).cast(AMOUNT)


def _share(column: str) -> Column:
    return F.col(column).cast("decimal(4,2)")


def sales_lines(spark: SparkSession, sf_dir: str, *countries: Country) -> DataFrame:
    """Order lines of the given sources, with ``source`` telling which one a line is from.

    Market and nation have a handful of rows, so Spark broadcasts them and the market filter
    reaches the customers before the large joins.
    """
    wanted = countries or COUNTRIES
    code = F.create_map(*[F.lit(x) for c in wanted for m in c.markets for x in (m, c.code)])
    markets = table(spark, sf_dir, "region").where(
        F.col("r_name").isin([m for c in wanted for m in c.markets])
    )
    nations = table(spark, sf_dir, "nation").join(
        markets, F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, sf_dir, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    text = "string"
    # Once for each part, not for each of its lines.
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat_ws("/", "p_brand", "p_name", "p_type", F.col("p_size").cast(text)).alias(
            "MOBILE_KEY"
        ),
        F.col("p_retailprice").cast(WHOLE_AMOUNT).alias("UNIT_PRICE"),
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )
    promotion = F.concat(
        F.lit("PROMO"), F.round(F.col("l_discount") * 100).cast("int").cast(text)
    )
    return lines.select(
        _order_key().cast(WHOLE).alias("SALES_ORDER_KEY"),
        F.concat(
            F.lit("ORD-"), F.col("l_orderkey").cast(text), F.lit("-"),
            F.col("l_linenumber").cast(text),
        ).alias("ORDER_ID"),
        F.col("c_name").alias("CUSTOMER_NAME"),
        "MOBILE_KEY",
        F.col("l_quantity").cast(WHOLE).alias("ORDER_QUANTITY"),
        "UNIT_PRICE",
        _money("l_extendedprice").alias("TOTAL_PRICE"),
        F.when(F.col("l_discount") > 0.02, promotion).alias("PROMOTION_CODE"),
        (_money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - _share("l_discount")))
        .cast(AMOUNT)
        .alias("FINAL_ORDER_AMOUNT"),
        (_money("l_extendedprice") * _share("l_tax")).cast(AMOUNT).alias("TAX_AMOUNT"),
        F.col("o_orderdate").cast("date").alias("ORDER_DT"),
        F.when(F.col("l_returnflag") == "R", "Pending").otherwise("Paid").alias(
            "PAYMENT_STATUS"
        ),
        F.when(F.col("l_linestatus") == "F", "Delivered").otherwise("Shipped").alias(
            "SHIPPING_STATUS"
        ),
        F.col("o_orderpriority").alias("PAYMENT_METHOD"),
        F.col("c_mktsegment").alias("PAYMENT_PROVIDER"),
        F.concat(
            F.lit("+"), F.col("c_custkey").cast(text), F.lit("-"),
            (F.col("o_orderkey") % 2).cast(text),
        ).alias("CONTACT"),
        F.concat_ws(" / ", "n_name", "c_name").alias("SHIPPING_ADDRESS"),
        F.col("l_shipdate").alias("_METADATA_LAST_MODIFIED"),
        code[F.col("r_name")].alias("source"),
    )


def source_rows(spark: SparkSession, sf_dir: str, country: Country) -> DataFrame:
    """The SOURCE rows of one country, without the file lineage that only files have."""
    return (
        sales_lines(spark, sf_dir, country)
        .drop("source")
        .withColumnRenamed("CONTACT", country.contact_column)
    )


def exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of rates per order day."""
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("DATE"))
    rupees = F.lit(70) + (F.dayofmonth("DATE") % 10) * F.lit(0.5).cast("decimal(2,1)")
    euros = F.lit(0.80).cast("decimal(3,2)") + F.month("DATE") * F.lit(0.01).cast("decimal(3,2)")
    return days.distinct().select(
        "DATE", euros.cast(RATE).alias("USD2EU"), rupees.cast(RATE).alias("USD2INR")
    )


def landing_text(
    spark: SparkSession, sf_dir: str, country: Country, spoil: bool = False,
    in_order: bool = False,
) -> DataFrame:
    """The landing fields of one source as text, ``in_order`` of their keys if wanted.

    ``spoil`` makes the tax of every pending order unreadable, and the date of every order
    line of 50 pieces, so that a load has rows to reject.
    """
    return as_landing(source_rows(spark, sf_dir, country), country, spoil, in_order)


def as_landing(
    rows: DataFrame, country: Country, spoil: bool = False, in_order: bool = False
) -> DataFrame:
    """The same of SOURCE rows that are there."""
    if in_order:
        rows = rows.orderBy("SALES_ORDER_KEY")
    text = rows.select(*[F.col(f.column).cast("string").alias(f.label) for f in country.fields])
    if not spoil:
        return text
    pending, fifty = F.col("Payment Status") == "Pending", F.col("Quantity") == "50"
    return text.withColumns(
        {
            "Tax": F.when(pending, "n/a").otherwise(F.col("Tax")),
            "Order Date": F.when(fifty, "someday").otherwise(F.col("Order Date")),
        }
    )


#: Fast compression: what repeats in text files, such as the names of JSON fields, goes with any.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_landing(
    text: DataFrame, root: str, country: Country, packed: bool = False, below: str = "",
    rows_a_file: int = 0,
) -> None:
    """Add landing files of one source below ``root``, in the format it arrives in; ``below`` is a
    folder in that of the source.

    ``packed`` text files are compressed with gzip; one task reads such a file, so ``rows_a_file``
    can bound it.
    """
    writer = text.write.mode("append")
    if rows_a_file:
        writer = writer.option("maxRecordsPerFile", rows_a_file)
    if country.file_format == "csv":
        writer = writer.option("header", country.csv_header)
    if packed and country.file_format != "parquet":
        writer = writer.options(**GZIP)
    folder = f"{root}/{country.directory}/{below}".rstrip("/")
    writer.format(country.file_format).save(folder)


def write_rates(rates: DataFrame, path: str) -> None:
    """Write an exchange-rate file with all its currency columns."""
    present = {c: F.col(c) for c in rates.columns}
    fields = [present.get(c, F.lit(1)).alias(c) for c in RATE_FIELDS]
    rates.select(*fields).write.option("header", True).csv(path)
