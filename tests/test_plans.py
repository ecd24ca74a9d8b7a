"""Physical plans keep the shape large tables need."""

from functools import partial

import __spark_entry__ as entry
from tallyspark.operators import joins, quality
from tallyspark.operators.dedup import earliest
from tallyspark.operators.metrics import metric
from tallyspark.plans import gold, marts, silver
from tallyspark.plans.bronze import typed
from tallyspark.plans.checks import run_checks
from tallyspark.plans.workbench import Workbench
from tallyspark.sources import testbed
from tests.conftest import SMALL, rows

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_cuts_before_the_shuffle(spark):
    w = entry.workbench(spark, SMALL)
    text = plan(earliest(w.bronze("pos_orders"), "order_line_id"))
    partial = text.index("Partial")
    final = text.index("Final")
    assert final < text.index("Exchange hashpartitioning(order_line_id") < partial


def test_fact_scan_reads_only_what_a_mart_needs(spark):
    w = entry.workbench(spark, SMALL)
    text = plan(marts.purchase_months(w.table("fact_sales"), w.table("dim_customer")))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "is_unknown_customer" in line)
    schema = scan.split("ReadSchema: ")[1]
    assert {c.split(":")[0] for c in schema.removeprefix("struct<").removesuffix(">").split(",")} == {
        "order_date", "customer_sk", "is_return", "is_unknown_customer",
    }
    assert "PushedFilters: [IsNotNull(is_unknown_customer)" in scan


def test_watermark_reaches_the_scan(spark):
    from tallyspark.operators.upsert import newer_than, read_watermark

    w = entry.workbench(spark, SMALL)
    orders = w.table("silver_orders")
    text = plan(newer_than(orders, read_watermark(w.table("fact_sales"))))
    assert "GreaterThan(_loaded_at" in text


def test_fact_lookups_broadcast_only_counted_tables(spark):
    w = entry.workbench(spark, SMALL)
    orders, customers, products = w.table("silver_orders"), w.table("dim_customer"), w.table("dim_product")
    small = plan(gold.fact_sales(orders, customers, products))
    assert small.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan(gold.fact_sales(orders, customers, products, max_broadcast_rows=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in large and "_salt" in large


def test_chained_lookups_scan_the_fact_once(spark):
    """Hot keys are found beforehand, so each salted lookup adds the scans of its own dimension only."""
    w = entry.workbench(spark, SMALL)
    orders, customers, products = w.table("silver_orders"), w.table("dim_customer"), w.table("dim_product")
    logical = gold.fact_sales(orders, customers, products, max_broadcast_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("order_line_id" in line for line in logical.splitlines() if "Relation" in line) == 1
    dims = {k: w.table(t).select(k).limit(50) for k, t in (("customer_sk", "dim_customer"), ("product_sk", "dim_product"), ("region_sk", "dim_region"))}
    orphans = quality.orphan_keys(w.table("fact_sales"), dims, max_broadcast_rows=0)
    logical = orphans._jdf.queryExecution().optimizedPlan().toString()
    assert sum("order_line_id" in line for line in logical.splitlines() if "Relation" in line) == 1


def test_the_suite_scans_a_fact_twice(spark):
    w = entry.workbench(spark, SMALL)
    suite = run_checks(w.tables("fact_sales", "dim_date", "dim_customer", "dim_product", "dim_region", "dim_channel"))
    logical = suite._jdf.queryExecution().optimizedPlan().toString()
    assert sum("order_line_id" in line for line in logical.splitlines() if "Relation" in line) == 2


def test_a_landed_feed_is_read_back(spark):
    """What was written is not derived again from orders and their lines."""
    w = Workbench(spark, SMALL)
    derived = w.raw("pos_orders")
    assert "Join" in plan(derived)
    w.landed("pos_orders")
    assert "Join" not in plan(w.bronze("pos_orders"))
    assert rows(w.raw("pos_orders")) == rows(derived) and w.raw("pos_orders").columns == derived.columns


def test_the_ledger_sums_its_lines_once(spark):
    w = entry.workbench(spark, SMALL)
    text = plan(testbed.raw_gl_extract(w.table("silver_orders"), w.table("silver_products")))
    assert sum("net_revenue_usd" in line for line in text.splitlines() if "FileScan" in line) == 1


def sketched_plans(monkeypatch):
    """Plans of the tables in which hot keys are looked for from here on."""
    seen, sketched = [], joins._sketched

    def watched(df, key, parts):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return sketched(df, key, parts)

    monkeypatch.setattr(joins, "_sketched", watched)
    return seen


def test_hot_keys_of_a_metric_are_looked_for_in_the_stored_fact(spark, monkeypatch):
    w = entry.workbench(spark, SMALL)
    tables = w.tables("fact_sales", "dim_region", "dim_channel", "dim_customer", "dim_product", "dim_date")
    asked = ("revenue_per_customer", ["customer_segment", "channel"], {}, "fiscal_year")
    expected, seen = rows(metric(tables, *asked)), sketched_plans(monkeypatch)
    assert rows(metric(tables, *asked, max_broadcast_rows=0)) == expected
    assert seen and not any("Aggregate" in text or "Join" in text for text in seen)


def test_hot_buyers_are_looked_for_in_the_stored_fact(spark, monkeypatch):
    w = entry.workbench(spark, SMALL)
    fact, customers = w.table("fact_sales"), w.table("dim_customer")
    expected, seen = rows(marts.purchase_months(fact, customers)), sketched_plans(monkeypatch)
    monkeypatch.setattr(marts, "lookup_join", partial(joins.lookup_join, max_broadcast_rows=0))
    assert rows(marts.purchase_months(fact, customers)) == expected
    assert len(seen) == 1 and "Aggregate" not in seen[0]


def test_lines_meet_their_customers_last(spark):
    """Their months are filled after it: from rows in the order of customers, so that lines of an order lie together."""
    w = entry.workbench(spark, SMALL)
    lines = gold.fact_lines(w.table("silver_orders"), w.table("dim_customer"), w.table("dim_product"), max_broadcast_rows=0)
    logical = lines._jdf.queryExecution().optimizedPlan().toString().splitlines()
    lookups = [line for line in logical if "Join LeftOuter" in line and "_copy#" in line]
    assert len(lookups) == 2 and "customer_id#" in lookups[0] and "product_id#" in lookups[1]


def test_lines_that_are_there_go_with_the_dedups_shuffle(spark):
    """Known lines leave right after the dedup, on its own layout, so that they meet no lookup."""
    w = Workbench(spark, SMALL)
    bronze, fx = w.bronze("pos_orders"), w.table("silver_fx_rates")
    lines = w.table("silver_orders")
    held = lines.where("region = 'ASIA'").select("order_line_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rest = silver.silver_orders(bronze, w.regions(), fx, held)
        text = plan(rest)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(rest) == rows(lines.where("region <> 'ASIA'"))
    assert text.count("Exchange hashpartitioning(order_line_id") == 2  # of the lines, and of the keys held
    assert text.index("raw_region") < text.index("LeftAnti")


def test_hot_keys_of_unstored_lines_are_looked_for_in_a_stored_table(spark, monkeypatch):
    w = Workbench(spark, SMALL)
    landed = typed(w.landed("pos_orders"), w.contracts["pos_orders"])
    orders = silver.silver_orders(landed, w.regions(), w.table("silver_fx_rates"))
    tables = (w.table("dim_customer"), w.table("dim_product"))
    expected, seen = rows(gold.fact_lines(orders, *tables)), sketched_plans(monkeypatch)
    base = silver.resolve_customer(landed)
    assert rows(gold.fact_lines(orders, *tables, max_broadcast_rows=0, base=base)) == expected
    assert len(seen) == 2 and not any("Window" in text or "Join" in text for text in seen)
