"""Warehouse build: raw tables to marts, each layer written before the next reads it.

Writing between layers keeps lineage short, gives the broadcast checks a table whose
size is known from its footers, and lets a failed step start from the last commit.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.calendar import FISCAL_START_MONTH, SPINE_END, SPINE_START, date_spine
from tallyspark.operators.upsert import newer_than, read_watermark
from tallyspark.plans import gold, marts, silver
from tallyspark.plans.bronze import typed
from tallyspark.sources.contracts import CONTRACTS, REGION_SPELLINGS, FeedContract
from tallyspark.sources.store import TableStore

GOLD = ("dim_customer", "dim_product", "dim_date", "dim_region", "dim_channel", "fact_sales", "fact_gl")
MARTS = ("monthly_revenue_bridge", "gross_margin_by_segment", "customer_cohort_retention")


#: Governed tables stored by month.
PARTITIONED: dict[str, Callable[[], Column]] = {"gold.fact_sales": lambda: fact_partition()}


@dataclass(frozen=True)
class Settings:
    """What varies between deployments."""

    captures: Sequence[dt.date]
    contracts: Mapping[str, FeedContract] = field(default_factory=lambda: CONTRACTS)
    regions: Sequence[tuple[str, str]] = REGION_SPELLINGS
    spine: tuple[dt.date, dt.date] = (SPINE_START, SPINE_END)
    fiscal_start: int = FISCAL_START_MONTH


def fact_partition() -> Column:
    """Facts are stored by order month."""
    return F.date_format("order_date", "yyyy-MM")


def order_partition() -> Column:
    """Sales lines are stored by order month."""
    return F.date_format("order_date", "yyyy-MM")


def taken(store: TableStore, consumer: str) -> int:
    """Version of its source that a step has taken rows up to; 0 before its first run."""
    mark = store.read(f"progress.{consumer}")
    return 0 if mark is None else mark.first()["version"]


def take(store: TableStore, consumer: str, version: int) -> None:
    """Record what a step has taken, after its result is committed: a run lost in between takes the rows again."""
    store.replace(f"progress.{consumer}", store.spark.createDataFrame([(version,)], "version bigint"))


def load_silver_orders(store: TableStore, contract: FeedContract, regions: DataFrame, fx: DataFrame) -> DataFrame:
    """Lines of the raw batches that came since the last load, added to those there are; the earliest landed copy of a
    line wins, so a line that is there already stays as it is.

    Only the new batches are read. Rates apply as of the load: after a restated rate, drop the table and load anew.
    Returns all lines.
    """
    source, target = f"raw.{contract.raw_table}", "silver.silver_orders"
    version = store.version(source)
    raw = store.read_since(source, taken(store, "silver_orders"))
    if raw is not None:
        rows = typed(raw, contract)
        lines = lambda held: silver.silver_orders(rows, regions, fx, held)
        store.insert_of(target, rows, lines, ["order_line_id"], order_partition())
        take(store, "silver_orders", version)
    return store.read(target)


def capture_products(store: TableStore, products: DataFrame, captures: Sequence[dt.date]) -> DataFrame:
    """The product snapshot with every capture up to now.

    Captures made before are not made again: their versions are stored state, which stays even when the extracts they
    came from are purged. A capture not after the newest one made is ignored.
    """
    name = "snapshots.product_snapshot"
    snapshot, made = store.read(name), store.read("snapshots.product_captures")
    newest = None if made is None else made.agg(F.max("capture")).first()[0]
    due = sorted(c for c in captures if newest is None or c > newest)
    if not due:
        return snapshot
    if snapshot is None:
        snapshot = store.replace(name, gold.product_snapshot(products, due))
    else:
        # One per scheduled run, as a rule; each is written before the next reads it.
        for day in due:
            snapshot = store.replace(name, gold.next_capture(snapshot, products, day))
    days = store.spark.createDataFrame([(d,) for d in due], "capture date")
    store.append("snapshots.product_captures", days)
    return snapshot


def build_silver(spark: SparkSession, store: TableStore, settings: Settings) -> None:
    def bronze(feed: str) -> DataFrame:
        contract = settings.contracts[feed]
        return typed(store.read(f"raw.{contract.raw_table}"), contract)

    regions = silver.region_map(spark, settings.regions)
    fx = store.replace("silver.silver_fx_rates", silver.silver_fx_rates(bronze("fx_rates")))
    load_silver_orders(store, settings.contracts["pos_orders"], regions, fx)
    store.replace("silver.silver_customers", silver.silver_customers(bronze("customer_master")))
    store.replace("silver.silver_products", silver.silver_products(bronze("product_master")))
    store.replace("silver.silver_gl", silver.silver_gl(bronze("gl_extract")))


def build_gold(spark: SparkSession, store: TableStore, settings: Settings) -> None:
    products = store.read("silver.silver_products")
    regions = store.replace("gold.dim_region", gold.dim_region(silver.region_map(spark, settings.regions)))
    store.replace("gold.dim_channel", gold.dim_channel(store.read("silver.silver_orders")))
    store.replace("gold.dim_date", gold.dim_date(date_spine(spark, *settings.spine), settings.fiscal_start))
    customers = store.replace("gold.dim_customer", gold.dim_customer(store.read("silver.silver_customers")))
    snapshot = capture_products(store, products, settings.captures)
    current = store.replace("gold.dim_product", gold.dim_product(snapshot, products))
    load_fact_sales(store, customers, current)
    store.replace("gold.fact_gl", gold.fact_gl(store.read("silver.silver_gl"), regions))


def load_fact_sales(store: TableStore, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Lines loaded since the last build, upserted by order line. Only folders of silver lines that are new are read,
    and of these the lines past the fact's newest load time."""
    source = "silver.silver_orders"
    version = store.version(source)
    orders = store.read_since(source, taken(store, "fact_sales"))
    if orders is not None:
        new = newer_than(orders, read_watermark(store.read("gold.fact_sales")))
        lines = gold.fact_lines(new, customers, products)
        store.upsert("gold.fact_sales", lines, ["order_line_id"], fact_partition(), gold.fact_columns(lines.columns))
        take(store, "fact_sales", version)
    return store.read("gold.fact_sales")


def build_marts(store: TableStore) -> None:
    fact, customers, dates = (store.read(f"gold.{t}") for t in ("fact_sales", "dim_customer", "dim_date"))
    store.replace("marts.monthly_revenue_bridge", marts.monthly_revenue_bridge(fact, dates))
    store.replace("marts.gross_margin_by_segment", marts.gross_margin_by_segment(fact, customers, dates))
    store.replace("marts.customer_cohort_retention", marts.customer_cohort_retention(fact, customers))


def build(spark: SparkSession, store: TableStore, settings: Settings) -> dict[str, DataFrame]:
    """Run every layer; returns the governed tables."""
    build_silver(spark, store, settings)
    build_gold(spark, store, settings)
    build_marts(store)
    return governed_tables(store)


def governed_tables(store: TableStore) -> dict[str, DataFrame]:
    """Gold and mart tables by name: all that metric requests may read."""
    named = [f"gold.{t}" for t in GOLD] + [f"marts.{t}" for t in MARTS]
    # Facts keep the column of their months, which metrics prune folders by.
    return {n.split(".")[1]: store.read(n, parts=n in PARTITIONED) for n in named if store.exists(n)}


def publish(store: TableStore, target: TableStore) -> dict[str, DataFrame]:
    """Copy the governed tables to a read-only set. Those stored by month are copied as they lie, without a shuffle."""
    named = [f"gold.{t}" for t in GOLD] + [f"marts.{t}" for t in MARTS]
    return {n: target.replace(n, store.read(n), PARTITIONED[n]() if n in PARTITIONED else None, lying=True) for n in named}
