"""Silver: deduplicated, conformed feeds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.calendar import month_start
from tallyspark.functions.casting import cents, narrowed
from tallyspark.functions.keys import UNKNOWN_MEMBER, is_missing_text, resolved_customer
from tallyspark.operators.dedup import earliest, latest
from tallyspark.operators.joins import multi_key_lookup, lookup_join

REPORTING_CURRENCY = "USD"
LINEAGE = ("_loaded_at", "_source_file", "_batch_id")


def region_map(spark: SparkSession, spellings: Iterable[tuple[str, str]]) -> DataFrame:
    """Seed table raw_region -> region_canonical."""
    return spark.createDataFrame(list(spellings), "raw_region string, region_canonical string")


def conform_region(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """Replace ``region`` by its canonical name ('Unknown' when unmapped), keeping
    the text as landed in ``region_raw``."""
    tagged = lines.withColumnRenamed("region", "region_raw").withColumn("_spelling", F.trim("region_raw"))
    joined = lookup_join(tagged, regions, "_spelling", "raw_region", row_id=["order_line_id"])
    canonical = F.coalesce("region_canonical", F.lit(UNKNOWN_MEMBER))
    return joined.withColumn("region", canonical).drop("_spelling", "raw_region", "region_canonical")


def resolve_customer(lines: DataFrame) -> DataFrame:
    """Missing or blank customers become the UNKNOWN member, flagged."""
    return lines.withColumns(
        {
            "is_unknown_customer": is_missing_text(F.col("customer_id")),
            "customer_id": resolved_customer(F.col("customer_id")),
        }
    )


def convert_currency(lines: DataFrame, fx: DataFrame, reporting: str = REPORTING_CURRENCY) -> DataFrame:
    """Add the month's rate into the reporting currency (1 when none is known) and
    the three amounts converted at it. Only rates into the reporting currency take
    part, so a line meets at most one."""
    rates = fx.where(F.col("to_currency") == reporting).select(
        F.col("rate_month").alias("_rate_month"), F.col("from_currency").alias("_from"), F.col("rate").alias("_rate")
    )
    keys = [("order_month", "_rate_month"), ("currency", "_from")]
    joined = multi_key_lookup(lines, rates, keys, row_id=["order_line_id"])
    priced = joined.withColumn("fx_rate_to_usd", F.coalesce("_rate", F.lit(1).cast("decimal(18,9)")))
    amounts = ("gross_revenue", "discount_amount", "net_revenue")
    usd = {f"{a}_usd": cents(F.col(a) * F.col("fx_rate_to_usd")) for a in amounts}
    return priced.withColumns(usd).drop("_rate_month", "_from", "_rate")


def silver_orders(bronze_pos: DataFrame, regions: DataFrame, fx: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """Sales lines: one row per order line, clean region, customer and USD amounts.
    Returns stay, flagged. Lines whose ``order_line_id`` is in ``held`` are left out.

    They go right after the dedup, whose shuffle has lines by that key already, so they cost no step below."""
    lines = earliest(bronze_pos, "order_line_id")
    if held is not None:
        lines = lines.join(held, "order_line_id", "left_anti")
    lines = lines.withColumns({"order_month": month_start(F.col("order_date")), "is_return": F.col("quantity") < 0})
    clean = convert_currency(resolve_customer(conform_region(lines, regions)), fx)
    clean = narrowed(clean, "unit_price", "gross_revenue", "discount_amount", "net_revenue")
    return clean.select(
        "order_line_id", "order_id", "order_date", "order_month",
        "customer_id", "is_unknown_customer", "product_id", "region", "region_raw",
        "channel", "quantity", "is_return", "currency",
        "unit_price", "discount_pct", "gross_revenue", "discount_amount", "net_revenue",
        "fx_rate_to_usd", "gross_revenue_usd", "discount_amount_usd", "net_revenue_usd",
        *LINEAGE,
    )


def silver_customers(bronze: DataFrame) -> DataFrame:
    """Customer history: one row per customer and extract, all extracts kept."""
    return latest(bronze, "customer_id", "extract_date").select(
        "customer_id", "extract_date", F.trim("customer_name").alias("customer_name"),
        "customer_segment", "region", "signup_date", *LINEAGE,
    )


def silver_products(bronze: DataFrame) -> DataFrame:
    """Product history: one row per product and extract, all extracts kept."""
    rows = narrowed(latest(bronze, "product_id", "extract_date"), "list_price", "standard_cost")
    return rows.select(
        "product_id", "extract_date", F.trim("description").alias("description"),
        "category", "subcategory", "list_price", "standard_cost", *LINEAGE,
    )


def silver_gl(bronze: DataFrame) -> DataFrame:
    """Ledger postings: one row per posting."""
    return narrowed(latest(bronze, "gl_id"), "amount_usd").select(
        "gl_id", "posting_date", month_start(F.col("posting_date")).alias("posting_month"),
        "account_code", "account_name", "region", "cost_center", "amount_usd", "currency",
        "source_system", *LINEAGE,
    )


def silver_fx_rates(bronze: DataFrame) -> DataFrame:
    """Rates: one row per month and currency pair."""
    monthly = bronze.withColumn("rate_month", month_start(F.col("rate_date")))
    return latest(monthly, "rate_month", "from_currency", "to_currency").select(
        "rate_month", "from_currency", "to_currency", "rate"
    )
