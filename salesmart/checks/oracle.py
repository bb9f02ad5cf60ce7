"""The same questions in plain SQL over the given tables.

Written from the definitions (windows, NOT IN, plain joins), not from the Spark plans.
"""

from __future__ import annotations

SOURCE = """
lines AS (
  SELECT cast(concat(l_orderkey, lpad(cast(l_partkey AS varchar), 11, '0'),
              lpad(cast(l_suppkey AS varchar), 10, '0'), l_linenumber,
              lpad(cast(cast(l_quantity AS bigint) AS varchar), 2, '0')) AS decimal(38,0))
           AS sales_order_key,
         concat('ORD-', l_orderkey, '-', l_linenumber) AS order_id,
         c_name AS customer_name,
         concat(p_brand, '/', p_name, '/', p_type, '/', p_size) AS mobile_key,
         cast(l_quantity AS bigint) AS order_quantity,
         cast(cast(p_retailprice AS decimal(38,0)) AS bigint) AS unit_price,
         cast(l_extendedprice AS decimal(12,2)) AS total_price,
         CASE WHEN l_discount > 0.02
              THEN concat('PROMO', cast(round(l_discount * 100) AS int)) END AS promotion_code,
         cast(cast(l_extendedprice AS decimal(12,2)) * (1 - cast(l_discount AS decimal(4,2)))
              AS decimal(12,2)) AS final_order_amount,
         cast(cast(l_extendedprice AS decimal(12,2)) * cast(l_tax AS decimal(4,2))
              AS decimal(12,2)) AS tax_amount,
         cast(o_orderdate AS date) AS order_dt,
         CASE WHEN l_returnflag = 'R' THEN 'Pending' ELSE 'Paid' END AS payment_status,
         CASE WHEN l_linestatus = 'F' THEN 'Delivered' ELSE 'Shipped' END AS shipping_status,
         o_orderpriority AS payment_method,
         c_mktsegment AS payment_provider,
         concat('+', c_custkey, '-', o_orderkey % 2) AS contact_no,
         concat(n_name, ' / ', c_name) AS shipping_address,
         l_shipdate AS modified,
         CASE WHEN r_name IN ('ASIA', 'MIDDLE EAST') THEN 'IN' WHEN r_name = 'AMERICA' THEN 'US'
              ELSE 'FR' END AS source
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
),
rates AS (
  SELECT DISTINCT cast(o_orderdate AS date) AS rate_date,
         cast(70 + (extract(day FROM o_orderdate) % 10) * 0.5 AS decimal(10,7)) AS usd2inr,
         cast(0.80 + extract(month FROM o_orderdate) * 0.01 AS decimal(10,7)) AS usd2eu
  FROM orders
)"""

# Conformed rows of all sources before filtering, with the rank that only India uses.
CONFORMED = (
    SOURCE
    + """,
priced AS (
  SELECT lines.*,
         CASE source WHEN 'IN' THEN 'India' WHEN 'US' THEN 'USA' ELSE 'France' END AS country,
         CASE source WHEN 'IN' THEN 'Asia' WHEN 'US' THEN 'North America' ELSE 'Europe' END
           AS region,
         CASE source WHEN 'IN' THEN 'INR' WHEN 'US' THEN 'USD' ELSE 'EUR' END AS local_currency,
         CASE source WHEN 'IN' THEN usd2inr WHEN 'US' THEN cast(1 AS decimal(10,7))
              ELSE usd2eu END AS exchange_rate
  FROM lines LEFT JOIN rates ON order_dt = rate_date
),
conformed AS (
  SELECT sales_order_key, order_id, order_dt, customer_name, mobile_key, country, region,
         order_quantity, local_currency, unit_price AS local_unit_price, promotion_code,
         final_order_amount AS local_total_order_amt, tax_amount AS local_tax_amt,
         exchange_rate,
         cast(round(cast(final_order_amount AS double) / cast(exchange_rate AS double), 6)
              AS decimal(18,6)) AS usd_total_order_amt,
         cast(round(cast(tax_amount AS double) / cast(exchange_rate AS double), 6)
              AS decimal(18,6)) AS usd_tax_amt,
         payment_status, shipping_status, payment_method, payment_provider, contact_no,
         shipping_address, year(order_dt) AS order_year, month(order_dt) AS order_month,
         quarter(order_dt) AS order_quarter, source, modified
  FROM priced
)"""
)

CURATED = (
    CONFORMED
    + """,
ranked AS (
  SELECT *, rank() OVER (PARTITION BY source, order_dt ORDER BY modified DESC NULLS LAST) AS rk
  FROM conformed WHERE payment_status = 'Paid' AND shipping_status = 'Delivered'
),
curated AS (
  SELECT DISTINCT * EXCLUDE (rk, modified) FROM ranked WHERE source <> 'IN' OR rk = 1
)"""
)

DIMENSIONS = (
    CURATED
    + """,
region_dim AS (
  SELECT row_number() OVER (ORDER BY country NULLS FIRST, region NULLS FIRST) AS region_id_pk, *
  FROM (SELECT DISTINCT country, region FROM curated)
),
product_dim AS (
  SELECT row_number() OVER (ORDER BY mobile_key NULLS FIRST) AS product_id_pk, *
  FROM (SELECT DISTINCT mobile_key, split_part(mobile_key, '/', 1) AS brand,
               split_part(mobile_key, '/', 2) AS model, split_part(mobile_key, '/', 3) AS color,
               split_part(mobile_key, '/', 4) AS memory FROM curated)
),
promo_dim AS (
  SELECT row_number() OVER (ORDER BY promotion_code, country NULLS FIRST, region NULLS FIRST)
           AS promo_code_id_pk, *
  FROM (SELECT DISTINCT coalesce(promotion_code, 'NA') AS promotion_code, country, region
        FROM curated)
),
customer_dim AS (
  SELECT row_number() OVER (ORDER BY customer_name NULLS FIRST, contact_no NULLS FIRST,
           shipping_address NULLS FIRST, country NULLS FIRST, region NULLS FIRST)
           AS customer_id_pk, *
  FROM (SELECT DISTINCT customer_name, contact_no, shipping_address, country, region
        FROM curated)
),
payment_dim AS (
  SELECT row_number() OVER (ORDER BY payment_method NULLS FIRST, payment_provider NULLS FIRST,
           country NULLS FIRST, region NULLS FIRST) AS payment_id_pk, *
  FROM (SELECT DISTINCT payment_method, payment_provider, country, region FROM curated)
),
date_dim AS (
  SELECT row_number() OVER (ORDER BY order_dt) AS date_id_pk, order_dt,
         row_number() OVER (ORDER BY order_dt) AS day_counter
  FROM (SELECT cast(unnest(generate_series(min(order_dt), max(order_dt), INTERVAL 1 DAY))
               AS date) AS order_dt FROM curated)
)"""
)

STAR = (
    DIMENSIONS
    + """,
star AS (
  SELECT c.*, date_id_pk, region_id_pk, payment_id_pk, product_id_pk, promo_code_id_pk
  FROM curated c
  JOIN date_dim USING (order_dt)
  JOIN region_dim r ON c.country = r.country AND c.region = r.region
  JOIN payment_dim p ON c.payment_method = p.payment_method
    AND c.payment_provider = p.payment_provider AND c.country = p.country
    AND c.region = p.region
  JOIN product_dim USING (mobile_key)
  JOIN promo_dim o ON coalesce(c.promotion_code, 'NA') = o.promotion_code
    AND c.country = o.country AND c.region = o.region
),
fact_by_name AS (
  SELECT s.*, customer_id_pk FROM star s
  JOIN customer_dim d ON s.customer_name = d.customer_name AND s.country = d.country
    AND s.region = d.region
),
fact AS (
  SELECT s.*, customer_id_pk FROM star s
  JOIN customer_dim d ON s.customer_name = d.customer_name AND s.country = d.country
    AND s.region = d.region AND s.contact_no = d.contact_no
    AND s.shipping_address = d.shipping_address
)"""
)

HISTORY = (
    CURATED
    + """,
states AS (
  SELECT order_dt >= DATE '1998-01-01' AS late, customer_name, country, region, contact_no,
         shipping_address
  FROM curated
  QUALIFY row_number() OVER (PARTITION BY order_dt >= DATE '1998-01-01', customer_name,
    country, region ORDER BY order_dt DESC, sales_order_key DESC) = 1
),
changes AS (
  SELECT s.*,
         lag(contact_no) OVER w AS old_contact, lag(shipping_address) OVER w AS old_address,
         lag(late) OVER w AS had_earlier
  FROM states s WINDOW w AS (PARTITION BY customer_name, country, region ORDER BY late)
),
starts AS (
  SELECT *, CASE WHEN late THEN DATE '1998-01-01' ELSE DATE '1900-01-01' END AS valid_from
  FROM changes
  WHERE had_earlier IS NULL OR contact_no IS DISTINCT FROM old_contact
     OR shipping_address IS DISTINCT FROM old_address
),
history AS (
  SELECT customer_name, country, region, contact_no, shipping_address, valid_from,
         coalesce(lead(valid_from) OVER w, DATE '9999-12-31') AS valid_to,
         CASE WHEN lead(valid_from) OVER w IS NULL THEN 'Y' ELSE 'N' END AS isactive
  FROM starts WINDOW w AS (PARTITION BY customer_name, country, region ORDER BY valid_from)
)"""
)

KEY = "cast(sales_order_key AS varchar) AS sales_order_key"
DAY = "cast(order_dt AS varchar) AS order_dt"
CURATED_OUT = f"""{KEY}, order_id, {DAY}, customer_name, mobile_key, country, region,
  cast(order_quantity AS bigint) AS order_quantity, local_currency,
  cast(local_unit_price AS double) AS local_unit_price, promotion_code,
  cast(local_total_order_amt AS double) AS local_total_order_amt,
  cast(local_tax_amt AS double) AS local_tax_amt,
  cast(exchange_rate AS double) AS exchange_rate,
  cast(usd_total_order_amt AS double) AS usd_total_order_amt,
  cast(usd_tax_amt AS double) AS usd_tax_amt,
  payment_status, shipping_status, payment_method, payment_provider, contact_no,
  shipping_address, cast(order_year AS bigint) AS order_year,
  cast(order_month AS bigint) AS order_month, cast(order_quarter AS bigint) AS order_quarter"""
FACT_OUT = """order_id AS order_code, date_id_pk AS date_id_fk, region_id_pk AS region_id_fk,
  customer_id_pk AS customer_id_fk, payment_id_pk AS payment_id_fk,
  product_id_pk AS product_id_fk, promo_code_id_pk AS promo_code_id_fk,
  cast(order_quantity AS bigint) AS order_quantity,
  cast(local_total_order_amt AS double) AS local_total_order_amt,
  cast(local_tax_amt AS double) AS local_tax_amt,
  cast(exchange_rate AS double) AS exchange_rate,
  cast(usd_total_order_amt AS double) AS usd_total_order_amt,
  cast(usd_tax_amt AS double) AS usd_tax_amt"""
MODIFIED = "strftime(modified, '%Y-%m-%d %H:%M:%S') AS _metadata_last_modified"
REVENUE = "cast(sum(usd_total_order_amt) AS double) AS revenue_usd, count(*) AS n_sales"


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def _built(delivered: str) -> str:
    """The fact of a build, from its order lines and the wave of files each came with."""
    return _with(
        SOURCE,
        f""", delivered AS (
  {delivered}
),
kept AS (
  SELECT * REPLACE (CASE WHEN source = 'IN' THEN tax_amount
                         ELSE cast(cast(tax_amount AS decimal(38,0)) AS decimal(12,2)) END AS tax_amount),
         CASE source WHEN 'IN' THEN usd2inr WHEN 'US' THEN cast(1 AS decimal(10,7)) ELSE usd2eu END AS rate
  FROM (SELECT * FROM delivered WHERE payment_status = 'Paid' AND shipping_status = 'Delivered'
        QUALIFY source <> 'IN' OR rank() OVER (PARTITION BY source, order_dt ORDER BY wave DESC) = 1)
  JOIN rates ON order_dt = rate_date
)
SELECT CASE source WHEN 'IN' THEN 'India' WHEN 'US' THEN 'USA' ELSE 'France' END AS country,
  order_id AS order_code, {DAY}, customer_name, contact_no, mobile_key,
  coalesce(promotion_code, 'NA') AS promotion_code, payment_method, payment_provider,
  cast(order_quantity AS bigint) AS order_quantity,
  cast(final_order_amount AS double) AS local_total_order_amt,
  cast(tax_amount AS double) AS local_tax_amt,
  cast(cast(round(cast(final_order_amount AS double) / cast(rate AS double), 6) AS decimal(18,6)) AS double)
    AS usd_total_order_amt,
  cast(cast(round(cast(tax_amount AS double) / cast(rate AS double), 6) AS decimal(18,6)) AS double)
    AS usd_tax_amt,
  true AS keys_unique FROM kept""",
    )


def _landing(source: str, contact: str, tax_whole: bool) -> str:
    tax = "cast(cast(tax_amount AS decimal(38,0)) AS bigint)" if tax_whole else (
        "cast(tax_amount AS double)"
    )
    return _with(
        SOURCE,
        f"""SELECT order_id, customer_name, mobile_key, order_quantity, unit_price,
  cast(cast(total_price AS decimal(38,0)) AS bigint) AS total_price, promotion_code,
  cast(final_order_amount AS double) AS final_order_amount, {tax} AS tax_amount, {DAY},
  payment_status, shipping_status, payment_method, payment_provider, contact_no AS {contact},
  shipping_address FROM lines WHERE source = '{source}'""",
    )


def _curated(source: str) -> str:
    return _with(CURATED, f"SELECT {CURATED_OUT} FROM curated WHERE source = '{source}'")


def _distinct(columns: str) -> str:
    return _with(CURATED, f"SELECT DISTINCT {columns} FROM curated")


def _new_after_india(columns: str) -> str:
    return _with(
        CURATED,
        f"""SELECT DISTINCT {columns} FROM curated
EXCEPT SELECT {columns} FROM curated WHERE source = 'IN'""",
    )


PRODUCT_PARTS = """mobile_key, split_part(mobile_key, '/', 1) AS brand,
  split_part(mobile_key, '/', 2) AS model, split_part(mobile_key, '/', 3) AS color,
  split_part(mobile_key, '/', 4) AS memory"""
PROMOTION = "coalesce(promotion_code, 'NA') AS promotion_code, country, region"
CUSTOMER = "customer_name, contact_no, shipping_address, country, region"
PAYMENT = "payment_method, payment_provider, country, region"
SPOILED_TAX, SPOILED_DAY = "payment_status = 'Pending'", "order_quantity = 50"

ORACLE: dict[str, str] = {
    "scan_table": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders""",
    "scan_project_fx": _with(
        SOURCE,
        """SELECT cast(rate_date AS varchar) AS exchange_date,
  cast(usd2inr AS double) AS exchange_rate FROM rates""",
    ),
    "ingest_csv": _landing("IN", "mobile", False),
    "ingest_parquet": _landing("US", "phone", True),
    "ingest_json": _landing("FR", "phone", True),
    "scan_partitioned": _with(
        SOURCE,
        """SELECT source, 'parquet' AS format, count(*) AS n_rows FROM lines
WHERE source IN ('US', 'FR') GROUP BY source""",
    ),
    "ingest_lineage": _with(
        SOURCE,
        """SELECT source, count(*) AS n_rows, cast(0 AS bigint) AS n_files_misnumbered
FROM lines GROUP BY source""",
    ),
    "ingest_reject_rows": _with(
        SOURCE,
        f"""SELECT order_id, cast(order_quantity AS varchar) AS order_quantity, payment_status,
  CASE WHEN {SPOILED_TAX} AND {SPOILED_DAY} THEN 'Tax,Order Date'
       WHEN {SPOILED_TAX} THEN 'Tax' ELSE 'Order Date' END AS bad_fields
FROM lines WHERE source = 'IN' AND ({SPOILED_TAX} OR {SPOILED_DAY})""",
    ),
    "ingest_good_rows": _with(
        SOURCE,
        f"""SELECT order_id, order_quantity, {DAY}, cast(tax_amount AS double) AS tax_amount,
  cast(final_order_amount AS double) AS final_order_amount
FROM lines WHERE source = 'IN' AND NOT ({SPOILED_TAX} OR {SPOILED_DAY})""",
    ),
    "ingest_incremental": _with(
        SOURCE,
        f"""SELECT order_id, {DAY}, order_quantity,
  cast(final_order_amount AS double) AS final_order_amount, true AS keys_dense
FROM lines WHERE source = 'IN'""",
    ),
    "ingest_compacted": _with(
        SOURCE,
        f"""SELECT order_id, {DAY}, order_quantity,
  cast(final_order_amount AS double) AS final_order_amount,
  cast(coalesce(greatest(least(year(order_dt) - 1993, 4), 0), 0) AS bigint) AS batch_id,
  true AS keys_dense
FROM lines WHERE source = 'IN'""",
    ),
    "assign_load_key": _with(
        SOURCE,
        """SELECT order_id, source,
  row_number() OVER (PARTITION BY source ORDER BY sales_order_key) AS load_key
FROM lines""",
    ),
    "ingest_mixed_types": _with(
        SOURCE,
        """SELECT order_id, order_quantity,
  CASE WHEN order_quantity % 3 <> 2 THEN promotion_code END AS promotion_code,
  cast(final_order_amount AS double) AS final_order_amount FROM lines WHERE source = 'US'""",
    ),
    "ingest_large_amounts": _with(
        SOURCE,
        """SELECT order_id, unit_price * 1000000000 AS unit_price,
  cast(cast(total_price AS decimal(38,0)) AS bigint) AS total_price
FROM lines WHERE source = 'FR'""",
    ),
    "rate_rejects": _with(
        SOURCE,
        """SELECT 'DATE' AS bad_fields, count(*) AS n_lines FROM rates WHERE month(rate_date) = 12
UNION ALL SELECT 'repeated day', count(*) FROM rates WHERE month(rate_date) = 1""",
    ),
    "file_manifest": _with(
        SOURCE,
        """SELECT DISTINCT concat('source=', source, '/format=',
    CASE source WHEN 'IN' THEN 'csv' WHEN 'US' THEN 'parquet' ELSE 'json' END,
    '/order_year=', year(order_dt)) AS partition_dir,
  cast(1 AS bigint) AS n_files, true AS has_bytes FROM lines""",
    ),
    "load_exchange_rate": _with(
        SOURCE,
        """SELECT cast(rate_date AS varchar) AS date, cast(1 AS double) AS usd2usd,
  cast(usd2eu AS double) AS usd2eu, cast(usd2inr AS double) AS usd2inr FROM rates""",
    ),
    "append_rows": _with(
        SOURCE,
        f"""SELECT {DAY}, count(*) AS n_rows, cast(sum(final_order_amount) AS double) AS amount
FROM lines GROUP BY order_dt""",
    ),
    "recreate_target": _distinct(PROMOTION),
    "full_refresh": _with(
        SOURCE,
        f"""SELECT {DAY}, count(*) AS n_rows, cast(sum(final_order_amount) AS double) AS amount
FROM lines WHERE payment_status = 'Paid' AND shipping_status = 'Delivered'
GROUP BY order_dt""",
    ),
    "customer_sample": """SELECT c_custkey, c_name, cast(c_nationkey AS bigint) AS c_nationkey,
  c_mktsegment FROM customer ORDER BY c_custkey LIMIT 10""",
    "filter_eq": _with(
        SOURCE,
        f"""SELECT {KEY}, order_id, payment_status, shipping_status FROM lines
WHERE payment_status = 'Paid'""",
    ),
    "filter_paid_delivered": _with(
        SOURCE,
        f"""SELECT {KEY}, order_id, payment_status, shipping_status FROM lines
WHERE payment_status = 'Paid' AND shipping_status = 'Delivered'""",
    ),
    "enrich_country": _with(
        CONFORMED, f"SELECT {KEY}, order_id, country, region FROM conformed"
    ),
    "conform_sales": _with(CONFORMED, f"SELECT {CURATED_OUT} FROM conformed"),
    "fact_projection": _with(STAR, f"SELECT {KEY}, {FACT_OUT} FROM fact"),
    "default_promo_code": _with(
        SOURCE,
        f"""SELECT {KEY}, CASE WHEN promotion_code IS NULL THEN 'NA' ELSE promotion_code END
  AS promotion_code FROM lines""",
    ),
    "resolve_aliases": _with(
        SOURCE, f"SELECT {KEY}, promotion_code, contact_no FROM lines"
    ),
    "default_missing_col": _with(
        SOURCE, f"SELECT {KEY}, 'NA' AS promotion_code FROM lines"
    ),
    "fx_left_join": _with(
        SOURCE,
        f"""SELECT {KEY}, {DAY}, cast(usd2inr AS varchar) AS rate
FROM lines LEFT JOIN (SELECT * FROM rates WHERE month(rate_date) <> 12)
  ON order_dt = rate_date""",
    ),
    "dedup_latest_file": _with(
        CURATED, f"SELECT {KEY}, order_id, {DAY}, {MODIFIED} FROM ranked "
        "WHERE source = 'IN' AND rk = 1"
    ),
    "dedup_latest_file_joinback": _with(
        CURATED,
        f"""SELECT {KEY}, order_id, {DAY}, {MODIFIED} FROM (
  SELECT a.* FROM ranked a
  JOIN (SELECT sales_order_key AS kept FROM ranked WHERE source = 'IN' AND rk = 1)
    ON a.sales_order_key = kept)""",
    ),
    "anti_new_region": _new_after_india("country, region"),
    "anti_new_product": _new_after_india(PRODUCT_PARTS),
    "anti_new_payment": _new_after_india(PAYMENT),
    "anti_new_promo": _new_after_india(PROMOTION),
    "anti_new_customer": _new_after_india(CUSTOMER),
    "anti_not_in_dates": _with(
        DIMENSIONS,
        f"""SELECT {DAY}, day_counter FROM date_dim
WHERE date_dim.order_dt NOT IN (SELECT order_dt FROM curated WHERE source = 'IN')""",
    ),
    "join_date": _with(
        DIMENSIONS, f"SELECT {KEY}, date_id_pk FROM curated JOIN date_dim USING (order_dt)"
    ),
    "join_product": _with(
        DIMENSIONS, f"SELECT {KEY}, product_id_pk FROM curated JOIN product_dim USING (mobile_key)"
    ),
    "join_customer_fanout": _with(
        DIMENSIONS,
        f"""SELECT {KEY}, customer_id_pk FROM curated
JOIN customer_dim USING (customer_name, region, country)""",
    ),
    "join_payment": _with(
        DIMENSIONS,
        f"SELECT {KEY}, payment_id_pk FROM curated JOIN payment_dim USING ({PAYMENT})",
    ),
    "join_promo": _with(
        DIMENSIONS,
        f"""SELECT {KEY}, promo_code_id_pk FROM curated c JOIN promo_dim p
ON coalesce(c.promotion_code, 'NA') = p.promotion_code AND c.country = p.country
  AND c.region = p.region""",
    ),
    "join_region": _with(
        DIMENSIONS,
        f"SELECT {KEY}, region_id_pk FROM curated JOIN region_dim USING (country, region)",
    ),
    "sales_fact": _with(
        STAR,
        f"SELECT {FACT_OUT} FROM fact_by_name",
    ),
    "sales_fact_grain_safe": _with(
        STAR,
        f"SELECT {FACT_OUT} FROM fact",
    ),
    "fact_keys": _with(
        STAR,
        "SELECT count(*) AS n_rows, count(*) AS n_keys, count(*) AS last_key FROM fact_by_name",
    ),
    "fact_incremental": _built(
        """SELECT *, 1 AS wave FROM lines WHERE order_dt < DATE '1998-01-01'
  UNION ALL SELECT *, 2 FROM lines WHERE order_dt >= DATE '1998-01-01'
  UNION ALL SELECT *, 2 FROM lines
    WHERE order_dt < DATE '1998-01-01' AND source = 'US' AND order_quantity = 50
  UNION ALL SELECT * REPLACE (NULL AS order_id), 2 FROM lines
    WHERE order_dt < DATE '1998-01-01' AND source = 'FR' AND order_quantity = 1
  UNION ALL SELECT * REPLACE (order_quantity + 100 AS order_quantity), 2 FROM lines
    WHERE source = 'IN' AND order_dt BETWEEN DATE '1995-06-01' AND DATE '1995-06-30'
      AND order_quantity <= 25"""
    ),
    "fact_one_source": _built("SELECT *, 1 AS wave FROM lines WHERE source = 'IN'"),
    "fact_new_rows": _with(STAR, f"SELECT {KEY}, {FACT_OUT} FROM fact WHERE country <> 'India'"),
    "scd2_customer": _with(
        HISTORY,
        f"""SELECT {CUSTOMER}, cast(valid_from AS varchar) AS valid_from,
  cast(valid_to AS varchar) AS valid_to, isactive FROM history""",
    ),
    "fact_scd2_join": _with(
        # The same history, of customers without a name where 50 pieces were sold, from 1994 on.
        HISTORY.replace(
            "curated AS (\n  SELECT DISTINCT * EXCLUDE (rk, modified)",
            "curated AS (\n  SELECT DISTINCT * EXCLUDE (rk, modified) REPLACE "
            "(CASE WHEN order_quantity <> 50 THEN customer_name END AS customer_name)",
        ).replace("DATE '1900-01-01'", "DATE '1994-01-01'"),
        f"""SELECT {KEY}, h.contact_no AS version_contact_no,
  cast(valid_from AS varchar) AS valid_from, cast(valid_to AS varchar) AS valid_to
FROM curated c LEFT JOIN history h ON c.customer_name IS NOT DISTINCT FROM h.customer_name
  AND c.country = h.country AND c.region = h.region
  AND order_dt >= valid_from AND order_dt < valid_to""",
    ),
    "distinct_region": _distinct("country, region"),
    "distinct_product": _distinct(PRODUCT_PARTS),
    "distinct_promo": _distinct(PROMOTION),
    "distinct_customer": _distinct(CUSTOMER),
    "distinct_payment": _distinct(PAYMENT),
    "group_count": _with(
        CURATED, f"SELECT {PAYMENT}, count(*) AS n_sales FROM curated GROUP BY {PAYMENT}"
    ),
    "row_count": _with(SOURCE, "SELECT count(*) AS n_rows FROM lines"),
    "order_date_range": _with(
        SOURCE,
        """SELECT cast(min(order_dt) AS varchar) AS first_day,
  cast(max(order_dt) AS varchar) AS last_day FROM lines""",
    ),
    "distinct_dates": _with(
        SOURCE, "SELECT DISTINCT cast(order_dt AS varchar) AS order_dt FROM lines"
    ),
    "recon_counts": _with(
        CURATED, "SELECT country, count(*) AS n_rows FROM curated GROUP BY country"
    ),
    "kpi_total_revenue": _with(STAR, f"SELECT {REVENUE} FROM fact"),
    "kpi_revenue_by_country": _with(
        STAR, f"SELECT country, {REVENUE} FROM fact GROUP BY country"
    ),
    "kpi_daily_trend": _with(STAR, f"SELECT {DAY}, {REVENUE} FROM fact GROUP BY fact.order_dt"),
    "kpi_promo_usage": _with(
        STAR,
        f"""SELECT p.promotion_code, {DAY}, {REVENUE} FROM fact JOIN promo_dim p
USING (promo_code_id_pk) GROUP BY p.promotion_code, fact.order_dt""",
    ),
    "kpi_payment_mix": _with(
        STAR,
        """SELECT payment_method, count(*) AS n_sales,
  round(count(*) / cast(sum(count(*)) OVER () AS double), 6) AS share
FROM fact GROUP BY payment_method""",
    ),
    "kpi_filtered": _with(
        STAR,
        f"""SELECT country, {DAY}, {REVENUE} FROM fact
WHERE country IN ('India', 'France') AND order_year = 1997
  AND fact.order_dt BETWEEN DATE '1997-03-01' AND DATE '1997-10-31'
GROUP BY country, fact.order_dt""",
    ),
    "dedup_latest_per_order": _with(
        SOURCE,
        f"""SELECT {KEY}, order_id, {MODIFIED} FROM (
  SELECT * FROM lines
  QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY modified DESC NULLS LAST, sales_order_key DESC) = 1)""",
    ),
    "day_counter": _with(
        SOURCE,
        """SELECT cast(d AS varchar) AS order_dt, row_number() OVER (ORDER BY d) AS day_counter
FROM (SELECT cast(unnest(generate_series(min(order_dt), max(order_dt), INTERVAL 1 DAY)) AS date)
      AS d FROM lines)""",
    ),
    "union_distinct_sales": _with(CURATED, f"SELECT {CURATED_OUT} FROM curated"),
    "union_all_sales": _with(
        CURATED,
        f"""SELECT {KEY}, order_id, country FROM curated
UNION ALL SELECT {KEY}, order_id, country FROM curated WHERE source = 'IN'""",
    ),
    "split_mobile_key": """WITH keys AS (
  SELECT concat(p_brand, '/', p_name, '/', p_type, '/', p_size) AS mobile_key FROM part
  UNION ALL SELECT concat(p_brand, '/', p_name, '/', p_type) FROM part)
SELECT mobile_key, string_split(mobile_key, '/')[1] AS brand,
  string_split(mobile_key, '/')[2] AS model, string_split(mobile_key, '/')[3] AS color,
  string_split(mobile_key, '/')[4] AS memory FROM keys""",
    "typed_casts": """SELECT l_orderkey, cast(cast(l_extendedprice AS decimal(12,2)) AS double)
  AS price, cast(cast(l_shipdate AS date) AS varchar) AS day,
  CASE WHEN l_returnflag = 'R' THEN cast(-1 AS bigint) ELSE cast(l_quantity AS bigint) END
  AS quantity FROM lineitem""",
    "to_number_scale0": """SELECT l_orderkey,
  cast(cast(cast(l_extendedprice AS decimal(12,2)) AS decimal(38,0)) AS bigint) AS whole,
  cast(cast(cast(l_extendedprice AS decimal(12,2)) AS decimal(38,1)) AS double) AS tenths
FROM lineitem""",
    "json_path_extract": """SELECT event_id,
  coalesce(cast(json_extract_string(props, '$.k') AS bigint), -1) AS k,
  json_extract_string(props, '$."no such field"') AS missing FROM events""",
    "time_parts": """SELECT o_orderkey, cast(year(o_orderdate) AS bigint) AS order_year,
  cast(month(o_orderdate) AS bigint) AS order_month,
  cast(quarter(o_orderdate) AS bigint) AS order_quarter FROM orders""",
    "fx_convert": _with(
        CONFORMED,
        f"""SELECT {KEY}, cast(local_total_order_amt AS double) AS local_total_order_amt,
  cast(exchange_rate AS double) AS exchange_rate,
  cast(usd_total_order_amt AS double) AS usd_total_order_amt,
  cast(usd_tax_amt AS double) AS usd_tax_amt FROM conformed WHERE source <> 'US'""",
    ),
    "date_spine": """SELECT cast(cast(unnest(generate_series(cast(min(o_orderdate) AS date),
  cast(max(o_orderdate) AS date), INTERVAL 1 DAY)) AS date) AS varchar) AS order_dt
FROM orders""",
    "date_range_days": _with(
        SOURCE,
        "SELECT cast(date_diff('day', min(order_dt), max(order_dt)) + 1 AS bigint) AS n_days "
        "FROM lines",
    ),
    "key_small_dim": _with(
        DIMENSIONS, f"SELECT payment_id_pk + 100 AS payment_id_pk, {PAYMENT} FROM payment_dim"
    ),
    "key_grouped_offset": _with(
        SOURCE,
        f"""SELECT {DAY}, {KEY},
  row_number() OVER (ORDER BY lines.order_dt, lines.sales_order_key) AS row_key
FROM lines""",
    ),
    "dim_region": _with(DIMENSIONS, "SELECT *, 'Y' AS isactive FROM region_dim"),
    "dim_product": _with(DIMENSIONS, "SELECT *, 'Y' AS isactive FROM product_dim"),
    "dim_promo_code": _with(DIMENSIONS, "SELECT *, 'Y' AS isactive FROM promo_dim"),
    "dim_customer": _with(DIMENSIONS, "SELECT *, 'Y' AS isactive FROM customer_dim"),
    "dim_payment": _with(DIMENSIONS, "SELECT *, 'Y' AS isactive FROM payment_dim"),
    "dim_date": _with(
        DIMENSIONS,
        """SELECT date_id_pk, cast(order_dt AS varchar) AS order_dt, day_counter,
  cast(year(order_dt) AS bigint) AS order_year, cast(month(order_dt) AS bigint) AS order_month,
  cast(quarter(order_dt) AS bigint) AS order_quarter,
  cast(dayofweek(order_dt) AS bigint) AS order_dayofweek,
  strftime(order_dt, '%a') AS order_dayname,
  cast(day(order_dt) AS bigint) AS order_dayofmonth,
  CASE WHEN dayofweek(order_dt) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS order_weekday
FROM date_dim""",
    ),
    "dim_incremental_delta": _with(
        CURATED,
        f"""SELECT (SELECT count(*) FROM (SELECT DISTINCT {CUSTOMER} FROM curated
    WHERE source = 'IN')) + row_number() OVER (ORDER BY {CUSTOMER}) AS customer_id_pk,
  {CUSTOMER}, 'Y' AS isactive
FROM (SELECT DISTINCT {CUSTOMER} FROM curated
      EXCEPT SELECT {CUSTOMER} FROM curated WHERE source = 'IN')""",
    ),
    "curated_in": _curated("IN"),
    "curated_us": _curated("US"),
    "curated_fr": _curated("FR"),
    "dq_type_errors": _with(
        SOURCE,
        f"""SELECT column_name, CASE column_name
    WHEN 'Tax' THEN (SELECT count(*) FROM lines WHERE source = 'IN' AND {SPOILED_TAX})
    WHEN 'Order Date' THEN (SELECT count(*) FROM lines WHERE source = 'IN' AND {SPOILED_DAY})
    ELSE 0 END AS n_errors
FROM (VALUES ('Quantity'), ('Price per Unit'), ('Total Price'), ('Order Amount'), ('Tax'),
             ('Order Date')) AS checked(column_name)""",
    ),
    "dq_fx_accuracy": _with(
        CURATED,
        """SELECT country, count(*) AS n_rows, cast(0 AS bigint) AS n_wrong
FROM curated GROUP BY country""",
    ),
    "dq_fx_overflow": _with(
        CONFORMED,
        """SELECT country, count(*) AS n_rows,
  count(*) FILTER (month(order_dt) = 12 AND local_total_order_amt * 100 >= 100000) AS n_wrong
FROM conformed WHERE source <> 'US' GROUP BY country""",
    ),
    "dq_dim_duplicates": _with(
        DIMENSIONS,
        """SELECT dimension, checked, CASE WHEN dimension = 'customer by name'
    AND checked = 'identity' THEN (SELECT count(*) FROM (SELECT 1 FROM customer_dim
      GROUP BY customer_name, country, region HAVING count(*) > 1)) ELSE 0 END AS n_repeated
FROM (VALUES ('date'), ('region'), ('product'), ('promotion'), ('customer'),
             ('customer by name'), ('payment')) AS d(dimension),
     (VALUES ('key'), ('identity')) AS c(checked)""",
    ),
    "dq_fk_orphans": _with(
        STAR,
        """SELECT foreign_key, CASE WHEN foreign_key = 'region_id_fk'
    THEN (SELECT count(*) FROM fact WHERE country = 'France') ELSE 0 END AS n_orphans
FROM (VALUES ('date_id_fk'), ('region_id_fk'), ('customer_id_fk'), ('payment_id_fk'),
             ('product_id_fk'), ('promo_code_id_fk')) AS k(foreign_key)""",
    ),
    "dq_null_profile": _with(
        CURATED,
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_nulls FROM curated"
            for c in ("ORDER_ID", "ORDER_DT", "PROMOTION_CODE", "EXCHANGE_RATE", "CONTACT_NO")
        ),
    ),
    "dq_value_ranges": _with(
        CURATED,
        """SELECT 'quantity is positive' AS rule, count(*) FILTER (order_quantity <= 0)
  AS n_broken FROM curated
UNION ALL SELECT 'quantity is below 50', count(*) FILTER (order_quantity >= 50) FROM curated
UNION ALL SELECT 'tax is positive', count(*) FILTER (local_tax_amt <= 0) FROM curated""",
    ),
    "dq_row_counts": _with(
        STAR,
        """SELECT concat('source ', source) AS table_name, count(*) AS n_rows
FROM lines GROUP BY source
UNION ALL SELECT concat('curated ', source), count(*) FROM curated GROUP BY source
UNION ALL SELECT 'curated', count(*) FROM curated
UNION ALL SELECT 'fact', count(*) FROM fact
UNION ALL SELECT 'fact by customer name', count(*) FROM fact_by_name""",
    ),
}
