"""Feed contracts: what a landed file must look like.

A contract is a structural gate, not a cleaner. It rejects corrupt files (missing
columns, unparseable dates, an unknown currency) and lets through the dirt the
silver layer repairs: duplicate lines, free-text regions, missing customers and
negative return quantities.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

DTYPES = ("string", "integer", "float", "numeric", "date", "timestamp", "boolean")


@dataclass(frozen=True)
class ColumnRule:
    name: str
    dtype: str
    nullable: bool = False
    allowed: tuple[str, ...] | None = None
    min: float | str | None = None
    max: float | str | None = None
    regex: str | None = None
    unique: bool = False
    scale: int | None = None

    def __post_init__(self) -> None:
        if self.dtype not in DTYPES:
            raise ValueError(f"{self.name}: unknown dtype {self.dtype!r}")


@dataclass(frozen=True)
class FeedContract:
    feed: str
    source_system: str
    file_glob: str
    raw_table: str
    primary_key: tuple[str, ...]
    columns: tuple[ColumnRule, ...]
    unique_key: bool = False
    allow_extra: bool = False

    def __post_init__(self) -> None:
        unknown = [k for k in self.primary_key if k not in self.names]
        if unknown:
            raise ValueError(f"{self.feed}: key columns not declared: {unknown}")

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)

    @property
    def text_schema(self) -> T.StructType:
        """Landing schema: every column is text."""
        return T.StructType([T.StructField(n, T.StringType()) for n in self.names])

    def with_rules(self, **changes: dict) -> FeedContract:
        """Same feed with some column rules changed: with_rules(region={"allowed": ...})."""
        stray = set(changes) - set(self.names)
        if stray:
            raise ValueError(f"{self.feed}: no such columns: {sorted(stray)}")
        return replace(self, columns=tuple(replace(c, **changes.get(c.name, {})) for c in self.columns))


# The five feeds' accepted values, bounds and patterns.
REGIONS = ("Northeast", "Southeast", "Midwest", "West")
CHANNELS = ("Retail", "Online", "Wholesale")
CURRENCIES = ("USD", "EUR")
SEGMENTS = ("Consumer", "SMB", "Mid-Market", "Enterprise")
CATEGORIES = ("Apparel", "Footwear", "Accessories", "Home & Living", "Outdoor", "Beauty")
ACCOUNTS = ("4000", "5000", "6000", "6100", "6200")
SALES_WINDOW = {"min": "2022-02-01", "max": "2025-01-31"}
EXTRACT_WINDOW = {"min": "2022-02-01", "max": "2024-02-01"}
SIGNUP_WINDOW = {"min": "2020-01-01", "max": "2025-01-31"}

POS_ORDERS = FeedContract(
    feed="pos_orders",
    source_system="POS",
    file_glob="pos_orders.csv",
    raw_table="raw_pos_orders",
    primary_key=("order_line_id",),
    unique_key=False,  # repeated lines are expected and removed in silver
    columns=(
        ColumnRule("order_line_id", "string", regex=r"^OL-\d{8}$"),
        ColumnRule("order_id", "string", regex=r"^ORD-\d{7}$"),
        ColumnRule("order_date", "date", **SALES_WINDOW),
        ColumnRule("customer_id", "string", nullable=True, regex=r"^CUST-\d{6}$"),
        ColumnRule("product_id", "string", regex=r"^PROD-\d{4}$"),
        ColumnRule("region", "string"),
        ColumnRule("channel", "string", allowed=CHANNELS),
        ColumnRule("quantity", "integer"),
        ColumnRule("unit_price", "numeric", min=0),
        ColumnRule("discount_pct", "float", min=0, max=1),
        ColumnRule("gross_revenue", "numeric"),
        ColumnRule("discount_amount", "numeric"),
        ColumnRule("net_revenue", "numeric"),
        ColumnRule("currency", "string", allowed=CURRENCIES),
    ),
)

GL_EXTRACT = FeedContract(
    feed="gl_extract",
    source_system="ERP-GL",
    file_glob="gl_extract.csv",
    raw_table="raw_gl_extract",
    primary_key=("gl_id",),
    unique_key=True,
    columns=(
        ColumnRule("gl_id", "string", regex=r"^GL-\d{7}$"),
        ColumnRule("posting_date", "date", **SALES_WINDOW),
        ColumnRule("account_code", "string", allowed=ACCOUNTS),
        ColumnRule("account_name", "string"),
        ColumnRule("region", "string", allowed=REGIONS),
        ColumnRule("cost_center", "string"),
        ColumnRule("amount_usd", "numeric"),
        ColumnRule("currency", "string", allowed=("USD",)),
        ColumnRule("source_system", "string"),
    ),
)

CUSTOMER_MASTER = FeedContract(
    feed="customer_master",
    source_system="CRM-Master",
    file_glob="customer_master_*.csv",
    raw_table="raw_customer_master",
    primary_key=("customer_id", "extract_date"),
    unique_key=True,
    columns=(
        ColumnRule("extract_date", "date", **EXTRACT_WINDOW),
        ColumnRule("customer_id", "string", regex=r"^CUST-\d{6}$"),
        ColumnRule("customer_name", "string"),
        ColumnRule("customer_segment", "string", allowed=SEGMENTS),
        ColumnRule("region", "string", allowed=REGIONS),
        ColumnRule("signup_date", "date", **SIGNUP_WINDOW),
    ),
)

PRODUCT_MASTER = FeedContract(
    feed="product_master",
    source_system="PIM-Master",
    file_glob="product_master_*.csv",
    raw_table="raw_product_master",
    primary_key=("product_id", "extract_date"),
    unique_key=True,
    columns=(
        ColumnRule("extract_date", "date", **EXTRACT_WINDOW),
        ColumnRule("product_id", "string", regex=r"^PROD-\d{4}$"),
        ColumnRule("description", "string"),
        ColumnRule("category", "string", allowed=CATEGORIES),
        ColumnRule("subcategory", "string"),
        ColumnRule("list_price", "numeric", min=0),
        ColumnRule("standard_cost", "numeric", min=0),
    ),
)

FX_RATES = FeedContract(
    feed="fx_rates",
    source_system="Treasury-FX",
    file_glob="fx_rates.csv",
    raw_table="raw_fx_rates",
    primary_key=("rate_date", "from_currency", "to_currency"),
    unique_key=True,
    columns=(
        ColumnRule("rate_date", "date", **SALES_WINDOW),
        ColumnRule("from_currency", "string", allowed=CURRENCIES),
        ColumnRule("to_currency", "string", allowed=("USD",)),
        ColumnRule("rate", "numeric", min=0, scale=9),
    ),
)

CONTRACTS = {c.feed: c for c in (POS_ORDERS, GL_EXTRACT, CUSTOMER_MASTER, PRODUCT_MASTER, FX_RATES)}

# Observed region spellings and their canonical region.
REGION_SPELLINGS = (
    ("Northeast", "Northeast"),
    ("NorthEast", "Northeast"),
    ("N. East", "Northeast"),
    ("northeast", "Northeast"),
    ("Southeast", "Southeast"),
    ("SouthEast", "Southeast"),
    ("S. East", "Southeast"),
    ("southeast", "Southeast"),
    ("Midwest", "Midwest"),
    ("MidWest", "Midwest"),
    ("Mid-West", "Midwest"),
    ("midwest", "Midwest"),
    ("West", "West"),
    ("WEST", "West"),
    ("W.", "West"),
    ("west", "West"),
)
