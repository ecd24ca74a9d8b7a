"""Warehouse tables over one folder of source tables, written layer by layer.

Raw and bronze are lazy; silver, gold and marts are written on first use to the
shared folder the session names in ``spark.checkpoint.dir``, as a scheduled build
would, and read back from there.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.functions.calendar import date_spine
from tallyspark.plans import gold, marts, silver
from tallyspark.plans.bronze import typed
from tallyspark.plans.build import PARTITIONED
from tallyspark.sources import testbed
from tallyspark.sources.store import TableStore


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    A local session that names none keeps its tables beside its SQL warehouse, which Spark itself writes to."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/working-tables"


class Workbench:
    """Every warehouse table, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.store = TableStore(spark, f"{shared_folder(spark)}/warehouse-{uuid.uuid4().hex[:12]}")
        self.contracts = testbed.CONTRACTS_HERE
        self._built: dict[str, DataFrame] = {}
        self._raw: dict[str, DataFrame] = {}
        self._governed: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        return testbed.table(self.spark, self.sf_dir, name)

    def raw(self, feed: str) -> DataFrame:
        """A raw feed: as landed, if it was; else a plan, which is kept, so its size checks run once."""
        landed = self._built.get(self._raw_table(feed))
        if landed is not None:
            return landed
        if feed not in self._raw:
            if feed == "gl_extract":
                plan = testbed.raw_gl_extract(self.table("silver_orders"), self.table("silver_products"))
            else:
                plan = getattr(testbed, f"raw_{feed}")(self.spark, self.sf_dir)
            self._raw[feed] = plan
        return self._raw[feed]

    def landed(self, feed: str) -> DataFrame:
        """A raw feed as landing leaves it: written once, so that checks of many rules don't derive it for each."""
        name = self._raw_table(feed)
        if name not in self._built:
            self._built[name] = self.store.replace(name, self.raw(feed))
        return self._built[name]

    def _raw_table(self, feed: str) -> str:
        return f"raw.{self.contracts[feed].raw_table}"

    def bronze(self, feed: str) -> DataFrame:
        return typed(self.raw(feed), self.contracts[feed])

    def regions(self) -> DataFrame:
        return silver.region_map(self.spark, testbed.region_spellings())

    def plan(self, name: str) -> DataFrame:
        """The query behind a table, over the tables below it."""
        t = self.table
        makers: dict[str, Callable[[], DataFrame]] = {
            "silver_fx_rates": lambda: silver.silver_fx_rates(self.bronze("fx_rates")),
            "silver_orders": lambda: silver.silver_orders(self.bronze("pos_orders"), self.regions(), t("silver_fx_rates")),
            "silver_customers": lambda: silver.silver_customers(self.bronze("customer_master")),
            "silver_products": lambda: silver.silver_products(self.bronze("product_master")),
            "silver_gl": lambda: silver.silver_gl(self.bronze("gl_extract")),
            "product_snapshot": lambda: gold.product_snapshot(t("silver_products"), testbed.EXTRACTS),
            "dim_date": lambda: gold.dim_date(date_spine(self.spark, *testbed.SPINE)),
            "dim_region": lambda: gold.dim_region(self.regions()),
            "dim_channel": lambda: gold.dim_channel(t("silver_orders")),
            "dim_customer": lambda: gold.dim_customer(t("silver_customers")),
            "dim_product": lambda: gold.dim_product(t("product_snapshot"), t("silver_products")),
            "fact_sales": lambda: gold.fact_sales(*self.tables("silver_orders", "dim_customer", "dim_product").values()),
            "fact_gl": lambda: gold.fact_gl(t("silver_gl"), t("dim_region")),
            "monthly_revenue_bridge": lambda: marts.monthly_revenue_bridge(t("fact_sales"), t("dim_date")),
            "gross_margin_by_segment": lambda: marts.gross_margin_by_segment(
                t("fact_sales"), t("dim_customer"), t("dim_date")
            ),
            "customer_cohort_retention": lambda: marts.customer_cohort_retention(t("fact_sales"), t("dim_customer")),
        }
        return makers[name]()

    def table(self, name: str) -> DataFrame:
        """A written table, built on first use."""
        if name not in self._built:
            by_month = PARTITIONED.get(f"gold.{name}")
            if name == "fact_sales":
                # Lines go to their months while narrow.
                lines = gold.fact_lines(*self.tables("silver_orders", "dim_customer", "dim_product").values())
                self._built[name] = self.store.replace(name, lines, by_month(), gold.fact_columns(lines.columns))
            else:
                self._built[name] = self.store.replace(name, self.plan(name), by_month() if by_month else None)
        return self._built[name]

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in names}

    def governed(self, *names: str) -> dict[str, DataFrame]:
        """Tables as metric requests read them: facts with the column of their months."""
        for name in names:
            if name not in self._governed:
                self.table(name)
                self._governed[name] = self.store.read(name, parts=f"gold.{name}" in PARTITIONED)
        return {n: self._governed[n] for n in names}
