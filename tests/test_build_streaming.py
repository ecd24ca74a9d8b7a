"""From CSV drop folder to marts, in batch and as streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyspark.operators.metrics import metric
from tallyspark.plans import gold, silver
from tallyspark.plans.build import Settings, build, capture_products, load_fact_sales, load_silver_orders, publish

from tallyspark.sources import testbed
from tallyspark.sources.landing import land_feed
from tallyspark.sources.store import TableStore
from tallyspark.streaming.audit import call_counts
from tallyspark.streaming.facts import fact_stream
from tallyspark.streaming.landing import landing_stream
from tests.conftest import SMALL, rows

SETTINGS = Settings(captures=testbed.EXTRACTS, contracts=testbed.CONTRACTS_HERE, regions=testbed.region_spellings(), spine=testbed.SPINE)
JAN = dt.datetime(2002, 1, 1)


def dump(df, contract, folder, name):
    """Write a feed as one CSV file named as a source system would."""
    text = df.select(*contract.names).toPandas().fillna("")
    folder.mkdir(parents=True, exist_ok=True)
    text.to_csv(folder / name, index=False)


@pytest.fixture(scope="module")
def drop(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("drop")
    w = entry.workbench(spark, SMALL)
    c = testbed.CONTRACTS_HERE
    # 'N/A' reads as null at the gate and would reject the file.
    pos = w.raw("pos_orders").withColumn("region", F.when(F.col("region") != "N/A", F.col("region")).otherwise("Elsewhere"))
    dump(pos.where("order_date < '1999'"), c["pos_orders"], folder / "one", "pos_orders.csv")
    dump(pos.where("order_date >= '1999'"), c["pos_orders"], folder / "two", "pos_orders.csv")
    dump(w.raw("gl_extract"), c["gl_extract"], folder / "one", "gl_extract.csv")
    dump(w.raw("fx_rates").where("to_currency = 'USD'"), c["fx_rates"], folder / "one", "fx_rates.csv")
    for feed in ("customer_master", "product_master"):
        for day in testbed.EXTRACTS:
            dump(w.raw(feed).where(F.col("_source_file") == f"{feed}_{day}.csv"), c[feed], folder / "one", f"{feed}_{day}.csv")
    return folder


@pytest.fixture(scope="module")
def built(spark, drop, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("warehouse")))
    for i, part in enumerate(("one", "two")):
        for contract in testbed.CONTRACTS_HERE.values():
            report = land_feed(spark, store, str(drop / part), contract, JAN + dt.timedelta(days=i))
            assert {r.action for r in report} <= {"append"}
        if part == "one":
            tables = build(spark, store, SETTINGS)
            first = tables["fact_sales"].count()
    return store, first, build(spark, store, SETTINGS)


def test_incremental_build_adds_the_second_drop(built):
    store, first, tables = built
    fact = tables["fact_sales"]
    assert 0 < first < fact.count()
    assert fact.count() == fact.select("order_line_id").distinct().count() == store.read("silver.silver_orders").count()
    bridge = tables["monthly_revenue_bridge"].agg(F.sum("net_revenue")).first()[0]
    assert bridge == fact.agg(F.sum("net_revenue")).first()[0]


def test_rebuild_changes_nothing(spark, built):
    store, _, tables = built
    before = tables["fact_sales"].agg(F.count("*"), F.sum("net_revenue"), F.sum("cogs")).first()
    after = load_fact_sales(store, tables["dim_customer"], tables["dim_product"])
    assert after.agg(F.count("*"), F.sum("net_revenue"), F.sum("cogs")).first() == before


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_calendar_filters_prune_months(built):
    """A fiscal year and one month, by the join with the calendar; folders of other months are not opened."""
    _, _, tables = built
    for filters, grain in (({"fiscal_year": 1997}, "fiscal_month"), ({"fiscal_year": 1997, "region": "ASIA"}, "none")):
        found = metric(tables, "net_revenue", [], filters, grain)
        text = plan(found)
        scans = [line for line in text.splitlines() if "FileScan parquet" in line and "net_revenue" in line]
        assert scans and all("dynamicpruning" in s[s.index("PartitionFilters") :] for s in scans), text
        plain = {n: t.drop("_part") for n, t in tables.items()}
        assert rows(found) == rows(metric(plain, "net_revenue", [], filters, grain))
    one = tables["fact_sales"].where("_part = '1997-03'")
    assert "PartitionFilters: [isnotnull(_part" in plan(one) and 0 < one.count() < tables["fact_sales"].count()


def test_second_load_reads_the_new_batches_only(spark, drop, built, tmp_path):
    """The raw folders of the first load are unreadable by the second."""
    batch_store, _, _ = built
    contract, regions = testbed.CONTRACTS_HERE["pos_orders"], silver.region_map(spark, testbed.region_spellings())
    store = TableStore(spark, str(tmp_path))
    fx = batch_store.read("silver.silver_fx_rates")
    for i, part in enumerate(("one", "two")):
        land_feed(spark, store, str(drop / part), contract, JAN + dt.timedelta(days=i))
        out = load_silver_orders(store, contract, regions, fx)
        if part == "one":
            first = out.count()
            for f in tmp_path.glob("raw/raw_pos_orders/data/*/*/*.parquet"):
                f.write_bytes(b"not a parquet file")
    want = batch_store.read("silver.silver_orders")
    assert 0 < first < out.count() and rows(out.drop("_loaded_at")) == rows(want.drop("_loaded_at"))
    version = store.version("silver.silver_orders")
    assert load_silver_orders(store, contract, regions, fx).count() == want.count() and store.version("silver.silver_orders") == version


def test_captures_survive_purged_extracts(spark, tmp_path):
    products = entry.workbench(spark, SMALL).table("silver_products")
    store = TableStore(spark, str(tmp_path))
    for n, day in enumerate(testbed.EXTRACTS, 1):
        snapshot = capture_products(store, products.where(F.col("extract_date") == F.lit(day)), testbed.EXTRACTS[:n])
    assert rows(snapshot) == rows(gold.product_snapshot(products, testbed.EXTRACTS).select(snapshot.columns))
    version = store.version("snapshots.product_snapshot")
    capture_products(store, products.limit(0), testbed.EXTRACTS)
    assert store.version("snapshots.product_snapshot") == version


def test_metrics_over_the_store(built):
    _, _, tables = built
    total = metric(tables, "net_revenue", time_grain="none").first()[0]
    assert total == sum(r.net_revenue for r in metric(tables, "net_revenue", ["region"]).collect())


def test_publish(spark, built, tmp_path):
    store, _, tables = built
    out = publish(store, TableStore(spark, str(tmp_path)))
    assert {n.split(".")[1]: df.count() for n, df in out.items()} == {n: df.count() for n, df in tables.items()}


def run(writer):
    q = writer.trigger(availableNow=True).start()
    assert q.awaitTermination(300)
    assert q.exception() is None


def test_streams_equal_the_batch_build(spark, drop, built, tmp_path):
    batch_store, _, _ = built
    store = TableStore(spark, str(tmp_path / "warehouse"))
    contract = testbed.CONTRACTS_HERE["pos_orders"]
    for name in ("silver.silver_fx_rates", "gold.dim_customer", "gold.dim_product"):
        store.replace(name, batch_store.read(name))
    regions = silver.region_map(spark, testbed.region_spellings())
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    landed = []

    def step():
        run(landing_stream(spark, store, str(inbox), contract.__class__(**{**contract.__dict__, "file_glob": "pos_*.csv"}),
                           str(tmp_path / "ck_land"), lambda: JAN, landed.extend))
        run(fact_stream(spark, store, contract, regions, str(tmp_path / "ck_fact")))

    for i, part in enumerate(("one", "two")):
        (inbox / f"pos_{i}.csv").write_bytes((drop / part / "pos_orders.csv").read_bytes())
        step()
    (inbox / "pos_again.csv").write_bytes((drop / "one" / "pos_orders.csv").read_bytes())
    (inbox / "pos_bad.csv").write_text("a,b\n1,2\n")
    step()
    assert [r.action for r in landed] == ["append", "append", "skip", "reject"]
    cols = ["order_line_id", "customer_sk", "product_sk", "net_revenue", "cogs"]
    assert rows(store.read("gold.fact_sales").select(cols)) == rows(batch_store.read("gold.fact_sales").select(cols))


def test_audit_stream(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.log").write_text('{"event":"tool_call","tool":"t","decision":"allow"}\nnoise\n')
    counts = call_counts(spark, str(logs))
    seen = []
    writer = counts.writeStream.outputMode("update").foreachBatch(lambda df, _: seen.append(rows(df)))
    writer = writer.option("checkpointLocation", str(tmp_path / "ck"))
    run(writer)
    (logs / "b.log").write_text('{"event":"tool_call","tool":"t","decision":"allow"}\n{"event":"tool_call","tool":"t","decision":"deny"}\n')
    run(writer)
    assert [s for s in seen if s] == [[("t", "allow", 1)], [("t", "allow", 2), ("t", "deny", 1)]]


def test_stream_landing_takes_files_of_a_header_alone(spark, tmp_path):
    tables = {
        "region": spark.createDataFrame([(0, "ASIA")], "r_regionkey bigint, r_name string"),
        "nation": spark.createDataFrame([(0, 0)], "n_nationkey bigint, n_regionkey bigint"),
        "customer": spark.range(1000).selectExpr("id AS c_custkey", "concat('C', id) AS c_name", "0L AS c_nationkey", "'BUILDING' AS c_mktsegment"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    # Splits smaller than the one row group: the first task of a scan has no rows.
    sizes = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        bench = entry.workbench(spark, str(tmp_path))
        assert bench.raw("customer_master").select("customer_id").rdd.getNumPartitions() > 4
        landed = entry.queries()["stream_landing"](spark, str(tmp_path)).count()
        assert landed == bench.raw("customer_master").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
