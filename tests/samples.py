"""Small hand-made inputs."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from salesmart.config import AMOUNT, CURATED_COLUMNS, RATE, USD, WHOLE

# ---- Fixed values: types of the CURATED columns that are not text ----
CURATED_TYPES = {
    "SALES_ORDER_KEY": WHOLE, "ORDER_DT": "date", "ORDER_QUANTITY": WHOLE,
    "LOCAL_UNIT_PRICE": AMOUNT, "LOCAL_TOTAL_ORDER_AMT": AMOUNT, "LOCAL_TAX_AMT": AMOUNT,
    "EXCHANGE_RATE": RATE, "USD_TOTAL_ORDER_AMT": USD, "USD_TAX_AMT": USD,
    "ORDER_YEAR": "int", "ORDER_MONTH": "int", "ORDER_QUARTER": "int",
}
CURATED_SCHEMA = ", ".join(f"`{c}` {CURATED_TYPES.get(c, 'string')}" for c in CURATED_COLUMNS)

# A paid and delivered order line, as landing text.
LINE = {
    "Order ID": "O-1", "Customer Name": "Ann", "Mobile Model": "Brand/Model/Red/64",
    "Quantity": "2", "Price per Unit": "10", "Total Price": "20", "Promotion Code": "P1",
    "Order Amount": "19.50", "Tax": "1.25", "Order Date": "2020-01-31",
    "Payment Status": "Paid", "Shipping Status": "Delivered", "Payment Method": "Card",
    "Payment Provider": "Bank", "Phone": "1", "Delivery Address": "Street 1",
}


def csv_line(**changes) -> str:
    return ",".join({**LINE, **changes}.values())


def curated(spark, *rows: dict):
    """CURATED rows; what a row does not say has a plain value."""
    base = {
        "SALES_ORDER_KEY": Decimal(1), "ORDER_ID": "O-1", "ORDER_DT": date(2020, 1, 31),
        "CUSTOMER_NAME": "Ann", "MOBILE_KEY": "Brand/Model/Red/64", "Country": "India",
        "Region": "Asia", "ORDER_QUANTITY": Decimal(2), "LOCAL_CURRENCY": "INR",
        "LOCAL_UNIT_PRICE": Decimal(10), "PROMOTION_CODE": "P1",
        "LOCAL_TOTAL_ORDER_AMT": Decimal("20.00"), "LOCAL_TAX_AMT": Decimal("1.00"),
        "EXCHANGE_RATE": Decimal(2), "USD_TOTAL_ORDER_AMT": Decimal(10),
        "USD_TAX_AMT": Decimal("0.5"), "PAYMENT_STATUS": "Paid",
        "SHIPPING_STATUS": "Delivered", "PAYMENT_METHOD": "Card", "PAYMENT_PROVIDER": "Bank",
        "CONTACT_NO": "1", "SHIPPING_ADDRESS": "Street 1", "ORDER_YEAR": 2020,
        "ORDER_MONTH": 1, "ORDER_QUARTER": 1,
    }
    values = []
    for i, row in enumerate(rows, 1):
        full = {**base, "SALES_ORDER_KEY": Decimal(i), "ORDER_ID": f"O-{i}", **row}
        values.append(tuple(full[c] for c in CURATED_COLUMNS))
    return spark.createDataFrame(values, CURATED_SCHEMA)


def files_of(spark, *rows):
    """(key, day, modified) rows as a SOURCE-like frame."""
    return spark.createDataFrame(
        [(k, d and date.fromisoformat(d), m and datetime.fromisoformat(m)) for k, d, m in rows],
        "SALES_ORDER_KEY bigint, ORDER_DT date, _METADATA_LAST_MODIFIED timestamp",
    )


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    found = [tuple(row) for row in df.select(*columns).collect()]
    return sorted(found, key=lambda row: tuple((v is not None, v) for v in row))
