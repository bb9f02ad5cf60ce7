"""The registered queries: every operator run over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.checks.present import present
from salesmart.config import (
    COUNTRIES,
    CURATED_COLUMNS,
    FACT_PARTITION,
    FRANCE,
    INDIA,
    LANDING_FIELDS,
    RATE,
    USA,
)
from salesmart.functions.casts import json_field, to_number, typed
from salesmart.functions.columns import default_column, or_default, resolve_columns
from salesmart.functions.dates import order_period
from salesmart.functions.text import mobile_key_parts
from salesmart.operators import calendar, history, quality
from salesmart.operators.anti import not_in
from salesmart.operators.dedup import (
    latest_file_per_day,
    latest_file_per_day_by_key,
    latest_per_key,
)
from salesmart.operators.filters import settled, where_equal, with_market
from salesmart.operators.keys import number_by_range
from salesmart.operators.rates import rates_for, with_rate
from salesmart.operators.sets import union_all, union_distinct
from salesmart.operators.sinks import (
    append_or_recreate,
    append_rows,
    read_if_present,
    replace_rows,
)
from salesmart.plans import dimensions, fact, kpi
from salesmart.plans.audit import identified_by, references
from salesmart.plans.build import build_warehouse
from salesmart.plans.curate import conform, curate
from salesmart.plans.upkeep import compact_loads
from salesmart.sources.landing import load_landing, read_landing
from salesmart.sources.manifest import files_per_directory, landing_files
from salesmart.sources.rates import read_rate_files, read_rates
from salesmart.sources.testdata import (
    as_landing,
    exchange_rates,
    landing_text,
    sales_lines,
    source_rows,
    table,
    write_landing,
    write_rates,
)
from salesmart.sources.warehouse import Warehouse
from salesmart.staging import COMPACT, drop, let_shuffles_go, scratch_path, side_by_side, stage
from salesmart.streaming.incremental import LoadPaths, load_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The customer history is built from two loads, split on this day.
SECOND_LOAD = date(1998, 1, 1)
# In fact_scd2_join it begins on this one.
FIRST_VERSIONS = date(1994, 1, 1)
# The dashboard filters of kpi_filtered.
CHOSEN = kpi.Selection(
    countries=("India", "France"),
    year=1997,
    first_day=date(1997, 3, 1),
    last_day=date(1997, 10, 31),
)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = lambda spark, sf_dir: present(run(spark, sf_dir))
    return run


# ---- Inputs the queries share: the layers, written as the jobs would find them ----


def rate_table(spark, sf_dir):
    return stage(exchange_rates(spark, sf_dir), "exchange-rate")


def source_layer(spark, sf_dir, only_settled=False):
    """The SOURCE rows of all countries from one pass over the order tables."""
    lines = sales_lines(spark, sf_dir)
    layer = stage(settled(lines) if only_settled else lines, "source", ["source"])

    def of(country):
        rows = layer.where(F.col("source") == country.code).drop("source")
        return rows.withColumnRenamed("CONTACT", country.contact_column)

    return of


def curated_frames(spark, sf_dir, source=None):
    """The CURATED rows of each source, from a source layer that is there or a new one."""
    source, rates = side_by_side(
        lambda: source or source_layer(spark, sf_dir, only_settled=True),
        lambda: rate_table(spark, sf_dir),
    )
    return {c.code: curate(source(c), c, rates) for c in COUNTRIES}


def curated_sales(spark, sf_dir):
    """The distinct CURATED rows of all countries as a table."""
    return stage(union_distinct(*curated_frames(spark, sf_dir).values()), "all-sales")


def fact_rows(spark, sf_dir):
    """Fact rows, one per order line, and their dimensions."""
    sales = curated_sales(spark, sf_dir)
    star = fact.star_of(sales)
    return fact.fact_projection(fact.star_join(sales, star, grain_safe=True)), star


def india_only(sales):
    return sales.where(F.col("Country") == INDIA.country)


def landing_root(spark, sf_dir, *countries, spoil=False):
    root = scratch_path(spark, "landing")
    for country in countries:
        write_landing(landing_text(spark, sf_dir, country, spoil), root, country)
    return root


def landing_layer(spark, sf_dir, *countries, in_order=False, **folders):
    """What the landing fields of several sources hold, from one pass over the order tables.

    Nothing else is carried along, but for the key that ``in_order`` sorts by. ``folders`` are
    partitions of the written rows below those of the sources.
    """
    needed = [f.column for f in LANDING_FIELDS] + (["SALES_ORDER_KEY"] if in_order else [])
    lines = sales_lines(spark, sf_dir, *countries).select(*needed, "source")
    # Writing folders sorts the rows of a task, which the lines of one source do not need.
    levels = [*(["source"] if len(countries) > 1 else []), *folders]
    return stage(lines.withColumns(folders), "landing-fields", levels, codec=COMPACT)


def landing_text_of(layer, country, in_order=False):
    """The landing fields of one source as text."""
    rows = layer.where(F.col("source") == country.code)
    return as_landing(
        rows.withColumnRenamed("CONTACT", country.contact_column), country, in_order=in_order
    )


# ---- Scans, sources, sinks ----


@query
def scan_table(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@query
def scan_project_fx(spark, sf_dir):
    return rates_for(exchange_rates(spark, sf_dir), "USD2INR")


def _loaded(spark, sf_dir, country):
    rows = load_landing(spark, landing_root(spark, sf_dir, country), country).rows
    return rows.select(*[f.column for f in country.fields])


@query
def ingest_csv(spark, sf_dir):
    return _loaded(spark, sf_dir, INDIA)


@query
def ingest_parquet(spark, sf_dir):
    return _loaded(spark, sf_dir, USA)


@query
def ingest_json(spark, sf_dir):
    return _loaded(spark, sf_dir, FRANCE)


@query
def scan_partitioned(spark, sf_dir):
    root = scratch_path(spark, "partitioned")
    sales_lines(spark, sf_dir).withColumn("format", F.lit("parquet")).write.partitionBy(
        "source", "format"
    ).parquet(root)
    rows = spark.read.option("basePath", root).parquet(root)
    return (
        rows.where(F.col("source").isin("US", "FR"))
        .groupBy("source", "format")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query
def ingest_lineage(spark, sf_dir):
    root = scratch_path(spark, "landing")
    layer = landing_layer(spark, sf_dir, *COUNTRIES)
    for country in COUNTRIES:
        write_landing(landing_text_of(layer, country), root, country, packed=True)
    per_source = []
    number = F.col("_METADATA_ROW_NUMBER")
    for country in COUNTRIES:
        files = (
            load_landing(spark, root, country)
            .rows.groupBy("_METADATA_FILENAME")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.min(number).alias("first"),
                F.max(number).alias("last"),
                F.sum(number).alias("total"),
                F.count_if(F.col("_METADATA_LAST_MODIFIED").isNull()).alias("undated"),
            )
        )
        dense = (F.col("first") == 1) & (F.col("last") == F.col("n")) & (
            F.col("total") * 2 == F.col("n") * (F.col("n") + 1)
        )
        per_source.append(
            files.agg(
                F.sum("n").alias("n_rows"),
                F.count_if(~dense | (F.col("undated") > 0)).alias("n_files_misnumbered"),
            ).withColumn("source", F.lit(country.code))
        )
    return union_all(*per_source)


@query
def ingest_reject_rows(spark, sf_dir):
    root = landing_root(spark, sf_dir, INDIA, spoil=True)
    return load_landing(spark, root, INDIA).rejects.select(
        "ORDER_ID", "ORDER_QUANTITY", "PAYMENT_STATUS", "bad_fields"
    )


@query
def ingest_good_rows(spark, sf_dir):
    root = landing_root(spark, sf_dir, INDIA, spoil=True)
    return load_landing(spark, root, INDIA).rows.select(
        "ORDER_ID", "ORDER_QUANTITY", "ORDER_DT", "TAX_AMOUNT", "FINAL_ORDER_AMOUNT"
    )


@query
def ingest_incremental(spark, sf_dir):
    """Two waves of files, a run after each and one more that finds nothing new."""
    landing = scratch_path(spark, "landing")
    paths = LoadPaths(*[scratch_path(spark, n) for n in ("rows", "rejects", "keys", "seen")])
    text = landing_text(spark, sf_dir, INDIA)
    late = F.coalesce(F.col("Order Date") >= "1998-01-01", F.lit(False))
    for wave in (text.where(~late), text.where(late), None):
        if wave is not None:
            write_landing(wave, landing, INDIA)
        load_new_files(spark, landing, INDIA, paths)
    loaded = spark.read.parquet(paths.rows)
    keys = loaded.agg(
        F.count(F.lit(1)).alias("n"), F.max("SALES_ORDER_KEY").alias("last")
    ).select((F.col("n") == F.col("last")).alias("dense")).scalar()
    return loaded.select("ORDER_ID", "ORDER_DT", "ORDER_QUANTITY", "FINAL_ORDER_AMOUNT").withColumn(
        "keys_dense", keys
    )


@query
def ingest_compacted(spark, sf_dir):
    """Five waves of files, their batches packed after the third and after the fourth."""
    landing = scratch_path(spark, "landing")
    paths = LoadPaths(*[scratch_path(spark, n) for n in ("rows", "rejects", "keys", "seen")])
    text = landing_text_of(landing_layer(spark, sf_dir, INDIA), INDIA)
    wave = F.greatest(F.least(F.year(F.to_date("Order Date")) - 1993, F.lit(4)), F.lit(0))
    for number in range(5):
        write_landing(text.where(F.coalesce(wave, F.lit(0)) == number), landing, INDIA, packed=True)
        load_new_files(spark, landing, INDIA, paths)
        if number in (2, 3):
            compact_loads(Warehouse(spark, landing), paths, through=number - 1)
    loaded = read_if_present(spark, paths.rows)
    keys = loaded.agg(
        F.count_distinct("SALES_ORDER_KEY").alias("n"), F.max("SALES_ORDER_KEY").alias("last")
    ).select((F.col("n") == F.col("last")).alias("dense")).scalar()
    return loaded.select(
        "ORDER_ID", "ORDER_DT", "ORDER_QUANTITY", "FINAL_ORDER_AMOUNT", F.col("batch_id").cast("long")
    ).withColumn("keys_dense", keys)


@query
def ingest_mixed_types(spark, sf_dir):
    """Files of one source whose quantity is text, a long or a double; the last lack a column."""
    root, kind = scratch_path(spark, "landing"), F.col("Quantity").cast("int") % 3
    text = landing_text(spark, sf_dir, USA)
    write_landing(text.where(kind == 0), root, USA)
    write_landing(text.where(kind == 1).withColumn("Quantity", F.col("Quantity").cast("long")), root, USA)
    doubles = text.where(kind == 2).withColumn("Quantity", F.col("Quantity").cast("double"))
    write_landing(doubles.drop("Promotion Code"), root, USA)
    return load_landing(spark, root, USA).rows.select(
        "ORDER_ID", "ORDER_QUANTITY", "PROMOTION_CODE", "FINAL_ORDER_AMOUNT"
    )


@query
def ingest_large_amounts(spark, sf_dir):
    """Prices of twelve digits and more are loaded as they are."""
    root = scratch_path(spark, "landing")
    text = landing_text(spark, sf_dir, FRANCE)
    nine_zeros = F.concat(F.regexp_extract("Price per Unit", "^[0-9]+", 0), F.lit("000000000"))
    write_landing(text.withColumn("Price per Unit", nine_zeros), root, FRANCE)
    return load_landing(spark, root, FRANCE).rows.select("ORDER_ID", "UNIT_PRICE", "TOTAL_PRICE")


@query
def assign_load_key(spark, sf_dir):
    """Landing files in the order of their lines: the load keys follow files and rows."""
    root = scratch_path(spark, "landing")
    keyed = []
    layer = landing_layer(spark, sf_dir, *COUNTRIES, in_order=True)
    for country in COUNTRIES:
        write_landing(landing_text_of(layer, country, in_order=True), root, country, packed=True)
        rows = load_landing(spark, root, country).rows
        keyed.append(rows.select(
            "ORDER_ID", F.col("SALES_ORDER_KEY").alias("load_key"),
            F.lit(country.code).alias("source"),
        ))
    return union_all(*keyed)


@query
def file_manifest(spark, sf_dir):
    """A landing area with a folder and a file for each source and year."""
    root = scratch_path(spark, "landing")
    year = F.substring(F.col("ORDER_DT").cast("string"), 1, 4)
    layer = landing_layer(spark, sf_dir, *COUNTRIES, order_year=year)
    sent = layer.select("source", "order_year").distinct().collect()

    def write_year(country, year):
        # One task reads the folder of the year, so no row is shuffled for its file.
        rows = landing_text_of(layer.where(F.col("order_year").eqNullSafe(F.lit(year))), country)
        folder = f"order_year={'__HIVE_DEFAULT_PARTITION__' if year is None else year}"
        write_landing(rows.coalesce(1), root, country, packed=True, below=folder)

    layer.limit(0).write.csv(f"{root}/nothing")  # the landing area is there without any sales
    jobs = [
        lambda c=c, year=r["order_year"]: write_year(c, year)
        for c in COUNTRIES for r in sent if r["source"] == c.code
    ]
    if jobs:
        side_by_side(*jobs)
    found = [landing_files(spark, root, suffix) for suffix in (".csv.gz", ".parquet", ".json.gz")]
    return files_per_directory(union_all(*found)).select(
        "partition_dir", "n_files", (F.col("n_bytes") > 0).alias("has_bytes")
    )


def _rate_files(spark, sf_dir):
    """Two rate files: one of January with other rates, and a later one of all days, with another
    order and spelling of its columns and a line without a date for every day of December."""
    path = scratch_path(spark, "rates-file")
    rates = exchange_rates(spark, sf_dir)
    january = rates.where(F.month("DATE") == 1).withColumn("USD2EU", F.lit(1).cast(RATE))
    write_rates(january.coalesce(1), f"{path}/1")
    text = rates.select(
        F.col("USD2INR"), F.col("DATE").cast("string").alias("Date"),
        F.col("USD2EU").alias("USD2EUR"), F.lit("1").alias("usd2usd"),
    )
    spoiled = text.where(F.substring("Date", 6, 2) == "12").withColumn("Date", F.lit("someday"))
    text.union(spoiled).coalesce(1).write.option("header", True).csv(f"{path}/2")
    return path


@query
def load_exchange_rate(spark, sf_dir):
    rows = read_rates(spark, _rate_files(spark, sf_dir))
    return rows.select("DATE", "USD2USD", "USD2EU", "USD2INR")


@query
def rate_rejects(spark, sf_dir):
    """Lines without a usable date, and those of a day that a later line settles."""
    rejects = read_rate_files(spark, _rate_files(spark, sf_dir)).rejects
    return rejects.groupBy("bad_fields").agg(F.count(F.lit(1)).alias("n_lines"))


def _sums(rows):
    return rows.groupBy("ORDER_DT").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("FINAL_ORDER_AMOUNT").alias("amount")
    )


@query
def append_rows_by_name(spark, sf_dir):
    path = scratch_path(spark, "appended")
    for country in COUNTRIES:
        rows = sales_lines(spark, sf_dir, country)
        append_rows(rows.select(*reversed(rows.columns)) if country is FRANCE else rows, path)
    return _sums(read_if_present(spark, path))


@query
def recreate_target(spark, sf_dir):
    path = scratch_path(spark, "recreated")
    sales = curated_sales(spark, sf_dir)
    found = dimensions.members(sales, dimensions.PROMOTION)
    append_rows(found.select("country", "region"), path)
    append_or_recreate(found, path, dimensions.PROMOTION.identity)
    return read_if_present(spark, path)


@query
def full_refresh(spark, sf_dir):
    path = scratch_path(spark, "refreshed")
    replace_rows(sales_lines(spark, sf_dir), path)
    replace_rows(settled(read_if_present(spark, path)), path)
    return _sums(read_if_present(spark, path))


@query
def customer_sample(spark, sf_dir):
    """The feature is the limit: ten customers, in a stated order."""
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        .orderBy("c_custkey")
        .limit(10)
    )


# ---- Projections, filters, predicates ----


@query
def filter_eq(spark, sf_dir):
    return where_equal(sales_lines(spark, sf_dir), "PAYMENT_STATUS", "Paid").select(
        "SALES_ORDER_KEY", "ORDER_ID", "PAYMENT_STATUS", "SHIPPING_STATUS"
    )


@query
def filter_paid_delivered(spark, sf_dir):
    return settled(sales_lines(spark, sf_dir)).select(
        "SALES_ORDER_KEY", "ORDER_ID", "PAYMENT_STATUS", "SHIPPING_STATUS"
    )


@query
def enrich_country(spark, sf_dir):
    labelled = [with_market(sales_lines(spark, sf_dir, c), c) for c in COUNTRIES]
    return union_all(*labelled).select("SALES_ORDER_KEY", "ORDER_ID", "Country", "Region")


@query
def conform_sales(spark, sf_dir):
    """All rows of the three sources in one layout, whatever their status."""
    source, rates = side_by_side(
        lambda: source_layer(spark, sf_dir), lambda: rate_table(spark, sf_dir)
    )
    frames = []
    for c in COUNTRIES:
        rows = with_market(source(c), c)
        if c.rate_column:
            rows = with_rate(rows, rates, c.rate_column)
        frames.append(conform(rows, c))
    return union_all(*frames)


@query
def fact_projection(spark, sf_dir):
    return fact_rows(spark, sf_dir)[0]


@query
def default_promo_code(spark, sf_dir):
    return sales_lines(spark, sf_dir).select(
        "SALES_ORDER_KEY", or_default(F.col("PROMOTION_CODE")).alias("promotion_code")
    )


@query
def resolve_aliases(spark, sf_dir):
    renamed = sales_lines(spark, sf_dir).withColumnsRenamed(
        {"PROMOTION_CODE": "Promo_Code", "CONTACT": "CONCTACT_NO"}
    )
    return resolve_columns(renamed, ["sales_order_key", "promotion_code", "contact_no"])


@query
def default_missing_col(spark, sf_dir):
    rows = sales_lines(spark, sf_dir).drop("PROMOTION_CODE")
    return default_column(rows, "promotion_code", "NA").select(
        "SALES_ORDER_KEY", "promotion_code"
    )


# ---- Joins ----


@query
def fx_left_join(spark, sf_dir):
    """Rates are missing for every December, so those orders keep a NULL rate."""
    rates = stage(exchange_rates(spark, sf_dir).where(F.month("DATE") != 12), "rates")
    return with_rate(sales_lines(spark, sf_dir), rates, "USD2INR").select(
        "SALES_ORDER_KEY", "ORDER_DT", F.col("EXCHANGE_RATE").cast("string").alias("rate")
    )


@query
def dedup_latest_file_joinback(spark, sf_dir):
    sales = settled(stage(source_rows(spark, sf_dir, INDIA), "source"))
    return latest_file_per_day_by_key(sales).select(
        "SALES_ORDER_KEY", "ORDER_ID", "ORDER_DT", "_METADATA_LAST_MODIFIED"
    )


def _new_after_india(spark, sf_dir, dimension):
    """Members the other countries add to a dimension that India was loaded into."""
    sales = curated_sales(spark, sf_dir)
    existing = dimensions.members(india_only(sales), dimension)
    return dimensions.new_members(sales, dimension, existing)


@query
def anti_new_region(spark, sf_dir):
    return _new_after_india(spark, sf_dir, dimensions.REGION)


@query
def anti_new_product(spark, sf_dir):
    return _new_after_india(spark, sf_dir, dimensions.PRODUCT)


@query
def anti_new_payment(spark, sf_dir):
    return _new_after_india(spark, sf_dir, dimensions.PAYMENT)


@query
def anti_new_promo(spark, sf_dir):
    return _new_after_india(spark, sf_dir, dimensions.PROMOTION)


@query
def anti_new_customer(spark, sf_dir):
    return _new_after_india(spark, sf_dir, dimensions.CUSTOMER)


@query
def anti_not_in_dates(spark, sf_dir):
    sales = curated_sales(spark, sf_dir)
    return not_in(calendar.day_spine(sales), "order_dt", india_only(sales), "ORDER_DT")


def _keys_of(spark, sf_dir, key, join):
    sales = curated_sales(spark, sf_dir)
    return join(sales).select("SALES_ORDER_KEY", key)


def _member_join(spark, sf_dir, dimension):
    sales = fact.with_promotion(curated_sales(spark, sf_dir))
    rows = stage(dimensions.dimension_rows(sales, dimension), dimension.table)
    return fact.join_member(sales, rows, dimension).select("SALES_ORDER_KEY", dimension.key)


@query
def join_date(spark, sf_dir):
    sales = curated_sales(spark, sf_dir)
    days = stage(dimensions.date_rows(sales), "days")
    return fact.join_date(sales, days).select("SALES_ORDER_KEY", "date_id_pk")


@query
def join_product(spark, sf_dir):
    return _member_join(spark, sf_dir, dimensions.PRODUCT)


@query
def join_customer_fanout(spark, sf_dir):
    return _member_join(spark, sf_dir, dimensions.CUSTOMER)


@query
def join_payment(spark, sf_dir):
    return _member_join(spark, sf_dir, dimensions.PAYMENT)


@query
def join_promo(spark, sf_dir):
    return _member_join(spark, sf_dir, dimensions.PROMOTION)


@query
def join_region(spark, sf_dir):
    return _member_join(spark, sf_dir, dimensions.REGION)


@query
def sales_fact(spark, sf_dir):
    """The fact but for its drawn keys, which ``fact_keys`` checks."""
    sales = curated_sales(spark, sf_dir)
    return fact.sales_fact(sales, fact.star_of(sales)).drop("order_id_pk")


@query
def sales_fact_grain_safe(spark, sf_dir):
    sales = curated_sales(spark, sf_dir)
    rows = fact.sales_fact(sales, fact.star_of(sales), grain_safe=True)
    return rows.drop("order_id_pk")


@query
def fact_keys(spark, sf_dir):
    """Three loads of the fact, a country each: keys without a gap and without a repeat."""
    sales = curated_sales(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    dimensions.load_dimensions(warehouse, sales)
    for country in COUNTRIES:
        own = sales.where(F.col("Country") == country.country)
        fact.load_fact(warehouse, own, grain_safe=False)
    return warehouse.read("consumption", fact.FACT_TABLE).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(fact.FACT_KEY).alias("n_keys"),
        F.max(fact.FACT_KEY).alias("last_key"),
    )


#: Order lines of one landing file, where they are not dealt by day.
LINES_A_FILE = 500_000


def _landing_of_days(spark, text, root, country):
    """Landing files. Of a source whose latest file of a day counts, each has whole order days, as a
    market sends them; for the others no line is moved."""
    if country.latest_file_only:
        write_landing(text.repartition("Order Date"), root, country, packed=True)
    else:
        write_landing(text, root, country, packed=True, rows_a_file=LINES_A_FILE)
    let_shuffles_go(spark)


FIRST_LATE_DAY = "1998-01-01"
# What the second wave delivers again, by source: days, lines, and the change.
AGAIN = {
    "IN": ("`Order Date` BETWEEN '1995-06-01' AND '1995-06-30' AND CAST(Quantity AS int) <= 25",
           {"Quantity": "CAST(CAST(Quantity AS int) + 100 AS string)"}),
    "US": ("CAST(Quantity AS int) = 50", {}),
    "FR": ("CAST(Quantity AS int) = 1", {"Order ID": "CAST(NULL AS string)"}),
}


def _built_fact(warehouse):
    """The fact with the members of its dimensions, and whether its keys are unique."""
    star = fact.read_star(warehouse)
    rows = kpi.with_date(
        kpi.with_region(warehouse.read("consumption", fact.FACT_TABLE), star), star
    )
    for dimension, key in (
        (star.customer, "customer"), (star.product, "product"), (star.payment, "payment"),
        (star.promotion, "promo_code"),
    ):
        member = dimension.drop("isActive", "Country", "Region").withColumnRenamed(
            f"{key}_id_pk", f"{key}_id_fk"
        )
        rows = rows.join(member, f"{key}_id_fk")
    unique = rows.agg(
        (F.count(F.lit(1)) == F.countDistinct(fact.FACT_KEY)).alias("unique")
    ).scalar()
    return rows.select(
        "Country", "order_code", "order_dt", "customer_name", "contact_no", "mobile_key",
        "promotion_code", "payment_method", "payment_provider", "order_quantity",
        "local_total_order_amt", "local_tax_amt", "usd_total_order_amt", "usd_tax_amt",
    ).withColumn("keys_unique", unique)


@query
def fact_incremental(spark, sf_dir):
    """Three builds: of early days, of what arrives later, and of nothing new.

    The second wave has the late days, order lines that repeat one already loaded, lines without
    an order code, and Indian files that take the place of earlier ones for some of their days.
    """
    landing, rates = scratch_path(spark, "landing"), scratch_path(spark, "rates-file")
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    write_rates(exchange_rates(spark, sf_dir), rates)
    layer = landing_layer(spark, sf_dir, *COUNTRIES)
    let_shuffles_go(spark)
    texts = {c: landing_text_of(layer, c) for c in COUNTRIES}
    late = F.col("Order Date") >= FIRST_LATE_DAY
    for country, text in texts.items():
        _landing_of_days(spark, text.where(~late), landing, country)
    build_warehouse(warehouse, landing, rates)
    for country, text in texts.items():
        which, changed = AGAIN[country.code]
        again = text.where(~late).where(which).withColumns(
            {name: F.expr(value) for name, value in changed.items()}
        )
        _landing_of_days(spark, text.where(late).unionByName(again), landing, country)
    drop(layer)
    build_warehouse(warehouse, landing, rates)
    build_warehouse(warehouse, landing, rates)
    return _built_fact(warehouse)


@query
def fact_one_source(spark, sf_dir):
    """A build for which only one of the sources has sent files."""
    landing, rates = scratch_path(spark, "landing"), scratch_path(spark, "rates-file")
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    write_rates(exchange_rates(spark, sf_dir), rates)
    _landing_of_days(spark, landing_text(spark, sf_dir, INDIA), landing, INDIA)
    build_warehouse(warehouse, landing, rates)
    return _built_fact(warehouse)


@query
def fact_new_rows(spark, sf_dir):
    """India is in the fact already; its rows do not come again."""
    rows, star = fact_rows(spark, sf_dir)
    rows = stage(rows, "fact")
    india = where_equal(star.region, "Country", INDIA.country).select(
        F.col("region_id_pk").alias("region_id_fk")
    )
    return fact.new_fact_rows(rows, rows.join(india, "region_id_fk"))


def _history(sales, since=date(1900, 1, 1)):
    early = sales.where(F.col("ORDER_DT") < F.lit(SECOND_LOAD))
    late = sales.where(F.col("ORDER_DT") >= F.lit(SECOND_LOAD))
    first = history.first_versions(history.latest_state(early), since)
    return history.merge_versions(first, history.latest_state(late), SECOND_LOAD)


@query
def scd2_customer(spark, sf_dir):
    return _history(curated_sales(spark, sf_dir))


@query
def fact_scd2_join(spark, sf_dir):
    """Some customers have no name, and their history begins after the first sales."""
    sales = curated_sales(spark, sf_dir)
    nameless = F.when(F.col("ORDER_QUANTITY") != 50, F.col("CUSTOMER_NAME"))
    sales = stage(sales.withColumn("CUSTOMER_NAME", nameless), "sales")
    versions = stage(_history(sales, FIRST_VERSIONS), "customer-history")
    return history.version_at(sales, versions).select(
        "SALES_ORDER_KEY", "version_contact_no", "valid_from", "valid_to"
    )


# ---- Aggregations ----


def _distinct(spark, sf_dir, dimension):
    return dimensions.members(union_all(*curated_frames(spark, sf_dir).values()), dimension)


@query
def distinct_region(spark, sf_dir):
    return _distinct(spark, sf_dir, dimensions.REGION)


@query
def distinct_product(spark, sf_dir):
    return _distinct(spark, sf_dir, dimensions.PRODUCT)


@query
def distinct_promo(spark, sf_dir):
    return _distinct(spark, sf_dir, dimensions.PROMOTION)


@query
def distinct_customer(spark, sf_dir):
    return _distinct(spark, sf_dir, dimensions.CUSTOMER)


@query
def distinct_payment(spark, sf_dir):
    return _distinct(spark, sf_dir, dimensions.PAYMENT)


@query
def group_count(spark, sf_dir):
    sales = union_distinct(*curated_frames(spark, sf_dir).values())
    return dimensions.member_counts(sales, dimensions.PAYMENT)


@query
def row_count(spark, sf_dir):
    return sales_lines(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def order_date_range(spark, sf_dir):
    return calendar.date_range(sales_lines(spark, sf_dir)).drop("n_days")


@query
def distinct_dates(spark, sf_dir):
    return sales_lines(spark, sf_dir).select("ORDER_DT").distinct()


@query
def recon_counts(spark, sf_dir):
    frames = curated_frames(spark, sf_dir)
    return quality.row_counts(
        {c.country: frames[c.code] for c in COUNTRIES}, "country"
    )


@query
def kpi_total_revenue(spark, sf_dir):
    return kpi.total_revenue(fact_rows(spark, sf_dir)[0])


@query
def kpi_revenue_by_country(spark, sf_dir):
    return kpi.revenue_by_country(*fact_rows(spark, sf_dir))


@query
def kpi_daily_trend(spark, sf_dir):
    return kpi.daily_trend(*fact_rows(spark, sf_dir))


@query
def kpi_promo_usage(spark, sf_dir):
    return kpi.promotion_usage(*fact_rows(spark, sf_dir))


@query
def kpi_payment_mix(spark, sf_dir):
    return kpi.payment_mix(*fact_rows(spark, sf_dir))


@query
def kpi_filtered(spark, sf_dir):
    """On the fact as it is stored, by months, of which the filters choose some."""
    sales = curated_sales(spark, sf_dir)
    star = fact.star_of(sales)
    rows = stage(fact.stored_rows(sales, star, grain_safe=True), "fact", FACT_PARTITION)
    return (
        kpi.select_sales(rows, star, CHOSEN)
        .groupBy("Country", "order_dt")
        .agg(kpi.revenue().alias("revenue_usd"), F.count(F.lit(1)).alias("n_sales"))
    )


# ---- Windows and sets ----


@query
def dedup_latest_file(spark, sf_dir):
    sales = settled(stage(source_rows(spark, sf_dir, INDIA), "source"))
    return latest_file_per_day(sales).select(
        "SALES_ORDER_KEY", "ORDER_ID", "ORDER_DT", "_METADATA_LAST_MODIFIED"
    )


@query
def dedup_latest_per_order(spark, sf_dir):
    return latest_per_key(sales_lines(spark, sf_dir)).select(
        "SALES_ORDER_KEY", "ORDER_ID", "_METADATA_LAST_MODIFIED"
    )


@query
def day_counter(spark, sf_dir):
    return calendar.day_spine(sales_lines(spark, sf_dir))


@query
def union_distinct_sales(spark, sf_dir):
    """India is passed twice; its rows come once."""
    frames = curated_frames(spark, sf_dir)
    return union_distinct(frames["IN"], frames["US"], frames["FR"], frames["IN"])


@query
def union_all_sales(spark, sf_dir):
    frames = curated_frames(spark, sf_dir)
    return union_all(frames["IN"], frames["US"], frames["FR"], frames["IN"]).select(
        "SALES_ORDER_KEY", "ORDER_ID", "Country"
    )


# ---- Functions ----


@query
def split_mobile_key(spark, sf_dir):
    """Product keys of parts, and the same with the last part missing."""
    parts = table(spark, sf_dir, "part").select(
        F.concat_ws("/", "p_brand", "p_name", "p_type", F.col("p_size").cast("string")).alias(
            "mobile_key"
        ),
        F.concat_ws("/", "p_brand", "p_name", "p_type").alias("short"),
    )
    keys = parts.select("mobile_key").union(parts.select("short"))
    split = mobile_key_parts(F.col("mobile_key"))
    return keys.select("mobile_key", *[part.alias(name) for name, part in split.items()])


@query
def typed_casts(spark, sf_dir):
    """Text that fits its type, and text that does not."""
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("price"),
        F.col("l_shipdate").cast("date").cast("string").alias("day"),
        F.when(F.col("l_returnflag") == "R", F.col("l_returnflag"))
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("mixed"),
    )
    return raw.select(
        "l_orderkey",
        typed(F.col("price"), "decimal(12,2)").alias("price"),
        typed(F.col("day"), "date").alias("day"),
        F.coalesce(typed(F.col("mixed"), "decimal(10,0)"), F.lit(-1)).cast("bigint").alias(
            "quantity"
        ),
    )


@query
def to_number_scale0(spark, sf_dir):
    text = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", to_number(text).alias("whole"), to_number(text, 1).alias("tenths")
    )


@query
def json_path_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.coalesce(json_field(F.col("props"), "k", "bigint"), F.lit(-1)).alias("k"),
        json_field(F.col("props"), "no such field").alias("missing"),
    )


@query
def time_parts(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    parts = [part.alias(name) for name, part in order_period(day).items()]
    return table(spark, sf_dir, "orders").select("o_orderkey", *parts)


def _converted(spark, sf_dir, rates, change=lambda rows: rows):
    """All sales of the sources that are paid in another currency, in dollars."""
    frames = []
    for c in (INDIA, FRANCE):
        rows = with_rate(change(source_rows(spark, sf_dir, c)), rates, c.rate_column)
        frames.append(conform(with_market(rows, c), c))
    return union_all(*frames)


@query
def fx_convert(spark, sf_dir):
    return _converted(spark, sf_dir, rate_table(spark, sf_dir)).select(
        "SALES_ORDER_KEY", "LOCAL_TOTAL_ORDER_AMT", "EXCHANGE_RATE", "USD_TOTAL_ORDER_AMT",
        "USD_TAX_AMT",
    )


@query
def date_spine(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("ORDER_DT")
    )
    return calendar.day_spine(orders).select("order_dt")


@query
def date_range_days(spark, sf_dir):
    return calendar.date_range(sales_lines(spark, sf_dir)).select("n_days")


# ---- Keys and warehouse operators ----


@query
def key_small_dim(spark, sf_dir):
    sales = union_all(*curated_frames(spark, sf_dir).values())
    found = dimensions.members(sales, dimensions.PAYMENT)
    return number_by_range(found, dimensions.PAYMENT.identity, "payment_id_pk", 101)


@query
def key_grouped_offset(spark, sf_dir):
    rows = sales_lines(spark, sf_dir).select("ORDER_DT", "SALES_ORDER_KEY")
    return number_by_range(rows, ["ORDER_DT", "SALES_ORDER_KEY"], "row_key")


def _dimension(spark, sf_dir, dimension):
    return dimensions.dimension_rows(
        union_all(*curated_frames(spark, sf_dir).values()), dimension
    )


@query
def dim_region(spark, sf_dir):
    return _dimension(spark, sf_dir, dimensions.REGION)


@query
def dim_product(spark, sf_dir):
    return _dimension(spark, sf_dir, dimensions.PRODUCT)


@query
def dim_promo_code(spark, sf_dir):
    return _dimension(spark, sf_dir, dimensions.PROMOTION)


@query
def dim_customer(spark, sf_dir):
    return _dimension(spark, sf_dir, dimensions.CUSTOMER)


@query
def dim_payment(spark, sf_dir):
    return _dimension(spark, sf_dir, dimensions.PAYMENT)


@query
def dim_date(spark, sf_dir):
    return dimensions.date_rows(union_all(*curated_frames(spark, sf_dir).values()))


@query
def dim_incremental_delta(spark, sf_dir):
    """India's customers have keys already; the others get the keys that follow."""
    sales = curated_sales(spark, sf_dir)
    existing = stage(
        dimensions.dimension_rows(india_only(sales), dimensions.CUSTOMER), "customers"
    )
    return dimensions.dimension_rows(sales, dimensions.CUSTOMER, existing)


def _curated(spark, sf_dir, country):
    rates = rate_table(spark, sf_dir) if country.rate_column else None
    source = source_rows(spark, sf_dir, country)
    if country.latest_file_only:
        source = stage(source, "source")
    return curate(source, country, rates).select(*CURATED_COLUMNS)


@query
def curated_in(spark, sf_dir):
    return _curated(spark, sf_dir, INDIA)


@query
def curated_us(spark, sf_dir):
    return _curated(spark, sf_dir, USA)


@query
def curated_fr(spark, sf_dir):
    return _curated(spark, sf_dir, FRANCE)


# ---- Data quality ----


@query
def dq_type_errors(spark, sf_dir):
    root = landing_root(spark, sf_dir, INDIA, spoil=True)
    types = {f.label: f.type for f in INDIA.fields if f.type != "string"}
    return quality.type_errors(read_landing(spark, root, INDIA), types)


@query
def dq_fx_accuracy(spark, sf_dir):
    return quality.conversion_errors(union_all(*curated_frames(spark, sf_dir).values()))


@query
def dq_fx_overflow(spark, sf_dir):
    """Rates of nearly nothing in December: dollars that do not fit are missing, and are counted."""
    tiny = F.when(F.month("DATE") == 12, F.lit("0.0000001").cast(RATE))
    rates = exchange_rates(spark, sf_dir).withColumns(
        {c: F.coalesce(tiny, F.col(c)) for c in ("USD2EU", "USD2INR")}
    )
    hundredfold = (F.col("FINAL_ORDER_AMOUNT") * 100).cast("decimal(12,2)")
    sales = _converted(
        spark, sf_dir, stage(rates, "rates"),
        lambda rows: rows.withColumn("FINAL_ORDER_AMOUNT", hundredfold),
    )
    return quality.conversion_errors(sales)


@query
def dq_dim_duplicates(spark, sf_dir):
    star = fact.star_of(curated_sales(spark, sf_dir))
    # By name and market alone customers repeat: the reason for the fact's fan-out.
    by_name = (star.customer, dimensions.CUSTOMER.key, history.CUSTOMER_KEY)
    return quality.duplicate_members({**identified_by(star), "customer by name": by_name})


@query
def dq_fk_orphans(spark, sf_dir):
    """France is taken out of the region dimension, so its sales have lost their region."""
    rows, star = fact_rows(spark, sf_dir)
    rows = stage(rows, "fact")
    regions = star.region.where(F.col("Country") != FRANCE.country)
    return quality.orphans(
        rows, {**references(star), "region_id_fk": (regions, dimensions.REGION.key)}
    )


@query
def dq_null_profile(spark, sf_dir):
    sales = union_all(*curated_frames(spark, sf_dir).values())
    return quality.null_profile(
        sales, ["ORDER_ID", "ORDER_DT", "PROMOTION_CODE", "EXCHANGE_RATE", "CONTACT_NO"]
    )


@query
def dq_value_ranges(spark, sf_dir):
    sales = union_all(*curated_frames(spark, sf_dir).values())
    return quality.out_of_range(
        sales,
        {
            "quantity is positive": F.col("ORDER_QUANTITY") > 0,
            "quantity is below 50": F.col("ORDER_QUANTITY") < 50,
            "tax is positive": F.col("LOCAL_TAX_AMT") > 0,
        },
    )


@query
def dq_row_counts(spark, sf_dir):
    """Every layer is built once; counting what is written reads no column of it."""
    source = source_layer(spark, sf_dir)
    frames = curated_frames(spark, sf_dir, source)
    sales = stage(union_distinct(*frames.values()), "all-sales")
    star = fact.star_of(sales)
    joined = stage(fact.join_small_dimensions(sales, star), "joined")
    return quality.row_counts(
        {
            **{f"source {c.code}": source(c) for c in COUNTRIES},
            **{f"curated {c.code}": sales.where(F.col("Country") == c.country) for c in COUNTRIES},
            "curated": sales,
            "fact": fact.join_customer(joined, star.customer, grain_safe=True),
            "fact by customer name": fact.join_customer(joined, star.customer, grain_safe=False),
        }
    )


# ``append_rows`` is also the name of the operator it runs.
QUERIES["append_rows"] = QUERIES.pop("append_rows_by_name")
