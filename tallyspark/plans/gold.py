"""Gold: conformed dimensions and facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import calendar as cal
from tallyspark.functions.casting import cents
from tallyspark.functions.keys import (
    UNKNOWN_CUSTOMER,
    UNKNOWN_MEMBER,
    date_key,
    member_key,
    surrogate_key,
)
from tallyspark.operators import scd
from tallyspark.operators.joins import BROADCAST_ROWS, lookup_join

CUSTOMER_TRACKED = ("customer_segment", "region")
PRODUCT_CHECKED = ("category", "list_price")


def dim_date(spine: DataFrame, start_month: int = cal.FISCAL_START_MONTH) -> DataFrame:
    """Calendar and fiscal attributes of each day of a spine."""
    day = F.col("date_day")
    return spine.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).cast("bigint").alias("calendar_year"),
        F.quarter(day).cast("bigint").alias("calendar_quarter"),
        F.month(day).cast("bigint").alias("calendar_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        cal.fiscal_year(day, start_month).alias("fiscal_year"),
        cal.fiscal_label(cal.fiscal_year(day, start_month)).alias("fiscal_year_label"),
        cal.fiscal_month(day, start_month).alias("fiscal_month"),
        cal.fiscal_quarter(day, start_month).alias("fiscal_quarter"),
    )


def dim_channel(orders: DataFrame) -> DataFrame:
    names = orders.select(F.col("channel").alias("channel_name")).distinct()
    return names.select(surrogate_key(F.col("channel_name")).alias("channel_sk"), "channel_name")


def dim_region(regions: DataFrame) -> DataFrame:
    """Canonical regions plus the Unknown member."""
    unknown = regions.sparkSession.range(1).select(F.lit(UNKNOWN_MEMBER).alias("region_name"))
    names = regions.select(F.col("region_canonical").alias("region_name")).union(unknown).distinct()
    return names.select(surrogate_key(F.col("region_name")).alias("region_sk"), "region_name")


def customer_versions(customers: DataFrame) -> DataFrame:
    """Business-effective versions of each customer; attributes are those of the
    extract that opened the version."""
    src = customers.select(
        "customer_id", "extract_date", "customer_name", "customer_segment", "region", "signup_date"
    )
    starts = scd.version_starts(src, "customer_id", "extract_date", CUSTOMER_TRACKED)
    return scd.validity_windows(
        starts, "customer_id", "extract_date", F.lit(scd.BEGINNING_OF_TIME), F.lit(scd.END_OF_TIME)
    ).drop("extract_date")


def dim_customer(customers: DataFrame) -> DataFrame:
    """SCD2 customer dimension with an UNKNOWN member for unresolved sales."""
    unknown = customers.sparkSession.range(1).select(
        F.lit(UNKNOWN_CUSTOMER).alias("customer_id"),
        F.lit("Unknown Customer").alias("customer_name"),
        F.lit(UNKNOWN_MEMBER).alias("customer_segment"),
        F.lit(UNKNOWN_MEMBER).alias("region"),
        F.lit(None).cast("date").alias("signup_date"),
        F.lit(scd.BEGINNING_OF_TIME).alias("valid_from"),
        F.lit(scd.END_OF_TIME).alias("valid_to"),
    )
    versions = customer_versions(customers).unionByName(unknown)
    return versions.select(
        surrogate_key(F.col("customer_id"), F.col("valid_from")).alias("customer_sk"),
        "customer_id", "customer_name", "customer_segment", "region", "signup_date", "valid_from", "valid_to",
        (F.col("valid_to") == F.lit(scd.END_OF_TIME)).alias("is_current"),
    )


def product_snapshot(products: DataFrame, captures: Sequence[dt.date]) -> DataFrame:
    """Product versions by capture: a new one when category or list price changes."""
    src = products.select(
        "product_id", "description", "category", "subcategory", "list_price", "standard_cost", "extract_date"
    )
    return scd.replay_snapshots(src, "product_id", "extract_date", PRODUCT_CHECKED, captures)


def next_capture(snapshot: DataFrame, products: DataFrame, day: dt.date) -> DataFrame:
    """A stored snapshot after one more capture, of the products' state as of a day."""
    state = scd.state_as_of(products.select(*[c for c in snapshot.columns if c not in ("valid_from", "valid_to")]), "product_id", "extract_date", day)
    return scd.check_snapshot(snapshot, state, "product_id", PRODUCT_CHECKED, dt.datetime.combine(day, dt.time()))


def dim_product(snapshot: DataFrame, products: DataFrame) -> DataFrame:
    """SCD2 on category and list price, SCD1 on description."""
    shown = scd.overwrite_with_newest(snapshot, products, "product_id", "extract_date", "description")
    return shown.select(
        surrogate_key(F.col("product_id"), F.col("valid_from")).alias("product_sk"),
        "product_id", "description", "category", "subcategory", "list_price", "standard_cost", "valid_from",
        F.coalesce("valid_to", F.lit(scd.END_OF_TIME).cast("timestamp")).alias("valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )


def point_in_time_customer(
    orders: DataFrame, customers: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS, base: DataFrame | None = None,
    start: str | None = None,
) -> DataFrame:
    """Add the customer version in force on each order date: its key or, under the name ``start``, when it begins."""
    versions = customers.select(
        _key_or_start("customer_sk", start), F.col("customer_id").alias("_customer"), F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
    )
    in_force = (F.col("order_date") >= F.col("_from")) & (F.col("order_date") < F.col("_to"))
    joined = lookup_join(
        orders, versions, "customer_id", "_customer", ["order_line_id"],
        condition=in_force, max_broadcast_rows=max_broadcast_rows, base=base,
    )
    return joined.drop("_customer", "_from", "_to")


def current_product(
    orders: DataFrame, products: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS, base: DataFrame | None = None,
    start: str | None = None,
) -> DataFrame:
    """Add the current product version, its key or, under the name ``start``, when it begins, and its standard cost."""
    current = products.where("is_current").select(
        F.col("product_id").alias("_product"), _key_or_start("product_sk", start), "standard_cost"
    )
    joined = lookup_join(
        orders, current, "product_id", "_product", ["order_line_id"], max_broadcast_rows=max_broadcast_rows, base=base
    )
    return joined.drop("_product")


def _key_or_start(key: str, start: str | None) -> Column:
    return F.col(key) if start is None else F.col("valid_from").alias(start)


def keys_follow(dimension: DataFrame, key: str, natural: str) -> bool:
    """Whether every key of a dimension is the hash of its row's natural key and start; looks at all rows."""
    follows = F.col("valid_from").isNotNull() & F.col(key).eqNullSafe(surrogate_key(F.col(natural), F.col("valid_from")))
    return not dimension.where(~follows).take(1)


def fact_lines(
    orders: DataFrame, customers: DataFrame, products: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS,
    base: DataFrame | None = None,
) -> DataFrame:
    """Order lines with all that `fact_columns` makes the sales fact of, and no more: rows as they should be shuffled.

    The key of a version is 32 random letters, which no shuffle compresses. Where a dimension's keys are hashes of
    natural key and start, lines carry the start, and the key is hashed again later. ``base`` is a table with customers
    and products of about these lines to look for hot keys in, where ``orders`` is a plan and not stored.
    """
    base = orders if base is None else base
    customer = "_customer_from" if keys_follow(customers, "customer_sk", "customer_id") else None
    product = "_product_from" if keys_follow(products, "product_sk", "product_id") else None
    # Customers last: lines of an order then lie side by side, which packs them better in the next shuffle and in files.
    keyed = current_product(orders, products, max_broadcast_rows, base=base, start=product)
    placed = point_in_time_customer(keyed, customers, max_broadcast_rows, base=base, start=customer)
    return placed.select(
        "order_line_id", "order_id", "order_date", "customer_id", "product_id", customer or "customer_sk",
        product or "product_sk", "region", "channel", "is_return", "is_unknown_customer", "currency", "fx_rate_to_usd",
        "quantity", "gross_revenue_usd", "discount_amount_usd", "net_revenue_usd", "standard_cost", "_loaded_at",
    )


def fact_sales(
    orders: DataFrame, customers: DataFrame, products: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Sales fact, one row per order line.

    Region and channel keys follow from the conformed text (see ``member_key``), so
    only the customer and product lookups are joins.
    """
    lines = fact_lines(orders, customers, products, max_broadcast_rows)
    return lines.select(*fact_columns(lines.columns))


def fact_columns(carried: Sequence[str]) -> list[Column | str]:
    """Columns of the sales fact over `fact_lines`. Each follows from its line alone, so they can come after a shuffle."""

    def key(entity: str) -> Column:
        start = F.col(f"_{entity}_from")
        hashed = F.when(start.isNotNull(), surrogate_key(F.col(f"{entity}_id"), start))
        return (F.col(f"{entity}_sk") if f"{entity}_sk" in carried else hashed).alias(f"{entity}_sk")

    cost = F.col("quantity") * F.col("standard_cost")
    return [
        "order_line_id",
        "order_id",
        date_key(F.col("order_date")).alias("date_key"),
        "order_date",
        key("customer"),
        key("product"),
        member_key(F.col("region")).alias("region_sk"),
        member_key(F.col("channel")).alias("channel_sk"),
        "is_return",
        "is_unknown_customer",
        "currency",
        "fx_rate_to_usd",
        "quantity",
        F.col("gross_revenue_usd").alias("gross_revenue"),
        F.col("discount_amount_usd").alias("discount_amount"),
        F.col("net_revenue_usd").alias("net_revenue"),
        cents(cost).alias("cogs"),
        cents(F.col("net_revenue_usd") - cost).alias("gross_profit"),
        "_loaded_at",
    ]


def fact_gl(gl: DataFrame, regions: DataFrame) -> DataFrame:
    """Ledger fact, one row per posting; a region outside the dimension gets no key."""
    joined = lookup_join(
        gl, regions.select("region_sk", "region_name"), "region", "region_name", row_id=["gl_id"]
    )
    return joined.select(
        "gl_id",
        date_key(F.col("posting_date")).alias("date_key"),
        "posting_date",
        "posting_month",
        "region_sk",
        "account_code",
        "account_name",
        "cost_center",
        "amount_usd",
    )
