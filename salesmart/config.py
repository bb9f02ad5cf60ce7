"""What differs between countries, and the layouts of the layers."""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---- Fixed values: status literals, defaults and flags that the layers carry ----
PAID = "Paid"
DELIVERED = "Delivered"
NO_PROMOTION = "NA"
ACTIVE = "Y"
INACTIVE = "N"

# ---- Fixed values: types of the layers ----
WHOLE = "decimal(38,0)"
AMOUNT = "decimal(12,2)"
WHOLE_AMOUNT = "decimal(38,0)"
LARGE_AMOUNT = "decimal(38,2)"
RATE = "decimal(10,7)"
USD = "decimal(18,6)"


@dataclass(frozen=True)
class LandingField:
    """One landing field: its name in named formats, its SOURCE column and its type.

    The order of the fields is their position in a CSV line.
    """

    label: str
    column: str
    type: str


@dataclass(frozen=True)
class Country:
    """One sales source: where its files lie and how its rows become CURATED rows."""

    code: str
    file_format: str
    country: str
    region: str
    currency: str
    rate_column: str | None
    contact_column: str
    latest_file_only: bool
    markets: tuple[str, ...]
    whole_number_columns: tuple[str, ...] = ()
    csv_header: bool = True
    multi_line: bool = False

    @property
    def directory(self) -> str:
        return f"source={self.code}/format={self.file_format}"

    @property
    def fields(self) -> tuple[LandingField, ...]:
        named = []
        for field in LANDING_FIELDS:
            if field.column == "CONTACT":
                field = replace(field, column=self.contact_column)
            if field.column in self.whole_number_columns:
                field = replace(field, type=WHOLE_AMOUNT)
            named.append(field)
        return tuple(named)

    def with_scale(self, *exact_columns: str) -> "Country":
        """The same source, keeping the cents of the named columns."""
        kept = tuple(c for c in self.whole_number_columns if c not in exact_columns)
        return replace(self, whole_number_columns=kept)


# ---- Fixed values: the sixteen landing fields, in file order ----
LANDING_FIELDS = (
    LandingField("Order ID", "ORDER_ID", "string"),
    LandingField("Customer Name", "CUSTOMER_NAME", "string"),
    LandingField("Mobile Model", "MOBILE_KEY", "string"),
    LandingField("Quantity", "ORDER_QUANTITY", WHOLE),
    LandingField("Price per Unit", "UNIT_PRICE", AMOUNT),
    LandingField("Total Price", "TOTAL_PRICE", AMOUNT),
    LandingField("Promotion Code", "PROMOTION_CODE", "string"),
    LandingField("Order Amount", "FINAL_ORDER_AMOUNT", AMOUNT),
    LandingField("Tax", "TAX_AMOUNT", AMOUNT),
    LandingField("Order Date", "ORDER_DT", "date"),
    LandingField("Payment Status", "PAYMENT_STATUS", "string"),
    LandingField("Shipping Status", "SHIPPING_STATUS", "string"),
    LandingField("Payment Method", "PAYMENT_METHOD", "string"),
    LandingField("Payment Provider", "PAYMENT_PROVIDER", "string"),
    LandingField("Phone", "CONTACT", "string"),
    LandingField("Delivery Address", "SHIPPING_ADDRESS", "string"),
)

# ---- Fixed values: lineage columns at the end of every SOURCE table ----
LINEAGE_COLUMNS = ("_METADATA_FILENAME", "_METADATA_ROW_NUMBER", "_METADATA_LAST_MODIFIED")

# ---- Fixed values: the sources. ``markets`` are its sales areas in the test tables. ----
# An amount that does not fit its type is rejected with its row when it is loaded.
# The default scales drop the cents of unit and total prices everywhere, and of the tax in
# the US and French files; ``with_scale`` keeps them.
INDIA = Country(
    code="IN", file_format="csv", country="India", region="Asia", currency="INR",
    rate_column="USD2INR", contact_column="MOBILE", latest_file_only=True,
    markets=("ASIA", "MIDDLE EAST"),
    whole_number_columns=("UNIT_PRICE", "TOTAL_PRICE"),
)
USA = Country(
    code="US", file_format="parquet", country="USA", region="North America", currency="USD",
    rate_column=None, contact_column="PHONE", latest_file_only=False,
    markets=("AMERICA",),
    whole_number_columns=("UNIT_PRICE", "TOTAL_PRICE", "TAX_AMOUNT"),
)
FRANCE = Country(
    code="FR", file_format="json", country="France", region="Europe", currency="EUR",
    rate_column="USD2EU", contact_column="PHONE", latest_file_only=False,
    markets=("EUROPE", "AFRICA"),
    whole_number_columns=("UNIT_PRICE", "TOTAL_PRICE", "TAX_AMOUNT"),
)
COUNTRIES = (INDIA, USA, FRANCE)

# ---- Fixed values: the CURATED layout, the same for every country ----
CURATED_COLUMNS = (
    "SALES_ORDER_KEY", "ORDER_ID", "ORDER_DT", "CUSTOMER_NAME", "MOBILE_KEY",
    "Country", "Region", "ORDER_QUANTITY", "LOCAL_CURRENCY", "LOCAL_UNIT_PRICE",
    "PROMOTION_CODE", "LOCAL_TOTAL_ORDER_AMT", "LOCAL_TAX_AMT", "EXCHANGE_RATE",
    "USD_TOTAL_ORDER_AMT", "USD_TAX_AMT", "PAYMENT_STATUS", "SHIPPING_STATUS",
    "PAYMENT_METHOD", "PAYMENT_PROVIDER", "CONTACT_NO", "SHIPPING_ADDRESS",
    "ORDER_YEAR", "ORDER_MONTH", "ORDER_QUARTER",
)

# ---- Fixed values: the exchange-rate file, in field order ----
RATE_FIELDS = ("DATE", "USD2USD", "USD2EU", "USD2INR", "USD2CAD", "USD2UK", "USD2JP")

# ---- Fixed values: other spellings of a column, each tried in order ----
COLUMN_ALIASES = {
    "promotion_code": ("promo_code",),
    "contact_no": ("conctact_no",),
    "usd2eu": ("usd2eur",),
    "unit_price": ("price_per_unit",),
    "usd_total_order_amt": ("us_total_order_amt",),
}

# ---- Fixed values: the fact layout ----
FACT_COLUMNS = (
    "order_id_pk", "order_code", "date_id_fk", "region_id_fk", "customer_id_fk",
    "payment_id_fk", "product_id_fk", "promo_code_id_fk", "order_quantity",
    "local_total_order_amt", "local_tax_amt", "exchange_rate", "usd_total_order_amt",
    "usd_tax_amt",
)

# ---- Fixed values: the columns of joined sales that the fact renames ----
FACT_SOURCES = {
    "order_code": "order_id",
    "date_id_fk": "date_id_pk",
    "region_id_fk": "region_id_pk",
    "customer_id_fk": "customer_id_pk",
    "payment_id_fk": "payment_id_pk",
    "product_id_fk": "product_id_pk",
    "promo_code_id_fk": "promo_code_id_pk",
}

# Curated tables and the fact are folders of months: what a load changes, and what a dashboard asks for.
CURATED_PARTITION = ("ORDER_YEAR", "ORDER_MONTH")
FACT_PARTITION = ("order_year", "order_month")
