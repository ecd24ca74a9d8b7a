import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyspark.functions import calendar as cal
from tallyspark.functions.casting import cents, null_safe_cast, percent
from tallyspark.operators import joins
from tallyspark.operators.dedup import earliest, latest
from tallyspark.operators.upsert import newer_than, read_watermark, upsert
from tallyspark.plans import gold, marts, silver
from tallyspark.plans.bronze import typed
from tallyspark.sources import testbed
from tallyspark.sources.contracts import CONTRACTS, REGION_SPELLINGS
from tests.conftest import rows
from tests.test_gate import GOOD, POS, landed

LOADED = dt.datetime(2025, 1, 1)


def bronze(spark, *data, loaded=LOADED):
    meta = {"_loaded_at": F.lit(loaded), "_batch_id": F.lit("b"), "_source_system": F.lit("POS")}
    return typed(landed(spark, *data).withColumns(meta), POS)


def fx(spark, *data):
    return spark.createDataFrame(
        [(dt.date(2023, 5, 1), f, t, Decimal(r)) for f, t, r in data],
        "rate_month date, from_currency string, to_currency string, rate decimal(18,9)",
    )


def orders(spark, *data, rates=(("EUR", "USD", "1.0505"), ("EUR", "GBP", "0.85"))):
    return silver.silver_orders(bronze(spark, *data), silver.region_map(spark, REGION_SPELLINGS), fx(spark, *rates))


def test_integer_and_rounding_casts(spark):
    df = spark.createDataFrame([("3.0",), ("3.7",), ("-2",), ("x",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(null_safe_cast(F.col("s"), "integer")).collect()]
    assert got == [3, 4, -2, None, None, None]
    d = spark.createDataFrame([(Decimal("1.005"),), (Decimal("-1.005"),)], "x decimal(18,4)")
    assert [r[0] for r in d.select(cents(F.col("x"))).collect()] == [Decimal("1.01"), Decimal("-1.01")]
    z = spark.createDataFrame([(Decimal(1), Decimal(0))], "a decimal(18,2), b decimal(18,2)")
    assert z.select(percent(F.col("a"), F.col("b"))).first()[0] is None


def test_amounts_are_priced_before_they_are_narrowed(spark):
    """Nine decimals reach the conversion: 0.00495 is no cent, though its four decimals, 0.0050, would round to one."""
    row = orders(spark, GOOD | {"currency": "USD", "net_revenue": "0.00495", "unit_price": "8.400010009"}).first()
    assert row.net_revenue == Decimal("0.0050") and row.net_revenue_usd == Decimal("0.00")
    assert row.unit_price == Decimal("8.4000")
    huge = orders(spark, GOOD | {"net_revenue": "123456789012345.5"}).first()
    assert huge.net_revenue is None


def test_regions_are_conformed(spark):
    spelled = [s for s, _ in REGION_SPELLINGS] + [" West ", "Mars"]
    df = orders(spark, *[GOOD | {"order_line_id": f"OL-{i:08d}", "region": s} for i, s in enumerate(spelled)])
    got = {r.region_raw: r.region for r in df.collect()}
    assert got == dict(REGION_SPELLINGS) | {" West ": "West", "Mars": "Unknown"}


def test_missing_customers_and_returns(spark):
    df = orders(
        spark,
        GOOD,
        GOOD | {"order_line_id": "OL-2", "customer_id": None},
        GOOD | {"order_line_id": "OL-3", "customer_id": "  ", "quantity": "-1"},
    )
    got = {r.order_line_id: (r.customer_id, r.is_unknown_customer, r.is_return) for r in df.collect()}
    assert got == {
        "OL-00004217": ("CUST-000064", False, False),
        "OL-2": ("UNKNOWN", True, False),
        "OL-3": ("UNKNOWN", True, True),
    }


def test_currency_conversion(spark):
    eur = GOOD | {"order_line_id": "OL-2", "currency": "EUR"}
    got = {r.order_line_id: r for r in orders(spark, GOOD, eur).collect()}
    assert len(got) == 2  # the EUR to GBP rate does not multiply lines
    assert got["OL-2"].net_revenue_usd == Decimal("33.09") and got["OL-2"].fx_rate_to_usd == Decimal("1.0505")
    assert got["OL-00004217"].net_revenue_usd == Decimal("31.50") and got["OL-00004217"].fx_rate_to_usd == 1
    silent = orders(spark, eur, rates=(("EUR", "GBP", "0.85"),)).first()
    assert silent.fx_rate_to_usd == 1 and silent.net_revenue_usd == Decimal("31.50")


def test_dedup_directions(spark):
    early = bronze(spark, GOOD | {"region": "a"})
    late = bronze(spark, GOOD | {"region": "b"}, loaded=dt.datetime(2025, 2, 1))
    both = late.unionByName(early)
    assert earliest(both, "order_line_id").first().region == "a"
    assert latest(both, "order_line_id").first().region == "b"
    copies = early.unionByName(early).unionByName(bronze(spark, GOOD | {"region": "0"}))
    assert [r.region for r in earliest(copies, "order_line_id").collect()] == ["0"]


def test_fiscal_calendar(spark):
    days = ["2024-01-31", "2024-02-01", "2024-04-30", "2024-05-01", "2024-12-31"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("date_day"))
    got = [(r.fiscal_year, r.fiscal_quarter, r.fiscal_month, r.fiscal_year_label) for r in gold.dim_date(df).collect()]
    assert got == [(2023, 4, 12, "FY2023"), (2024, 1, 1, "FY2024"), (2024, 1, 3, "FY2024"), (2024, 2, 4, "FY2024"), (2024, 4, 11, "FY2024")]
    spine = cal.date_spine(spark, cal.SPINE_START, cal.SPINE_END)
    assert spine.count() == 1826
    assert spine.agg(F.max("date_day")).first()[0] == dt.date(2026, 1, 31)


def warehouse(spark, *data):
    o = orders(spark, *data)
    c = spark.createDataFrame(
        [("CUST-000064", dt.date(2022, 2, 1), "A", "Consumer", "West", None), ("CUST-000064", dt.date(2023, 2, 1), "A", "SMB", "West", None)],
        "customer_id string, extract_date date, customer_name string, customer_segment string, region string, signup_date date",
    )
    p = spark.createDataFrame(
        [("PROD-0207", dt.date(2022, 2, 1), "p", "Beauty", "s", Decimal(10), Decimal("6.005"))],
        "product_id string, extract_date date, description string, category string, subcategory string, list_price decimal(18,4), standard_cost decimal(18,4)",
    )
    dc = gold.dim_customer(c)
    dp = gold.dim_product(gold.product_snapshot(p, [dt.date(2022, 2, 1)]), p)
    return o, dc, dp


def test_fact_sales(spark):
    o, dc, dp = warehouse(
        spark,
        GOOD,
        GOOD | {"order_line_id": "OL-2", "order_date": "2023-01-31"},
        GOOD | {"order_line_id": "OL-3", "customer_id": "", "product_id": "PROD-9999"},
    )
    plain = gold.fact_sales(o, dc, dp)
    assert rows(gold.fact_sales(o, dc, dp, max_broadcast_rows=0).select(plain.columns)) == rows(plain)
    segment = {r.customer_sk: (r.customer_id, r.customer_segment) for r in dc.collect()}
    got = {r.order_line_id: r for r in plain.collect()}
    assert segment[got["OL-00004217"].customer_sk] == ("CUST-000064", "SMB")
    assert segment[got["OL-2"].customer_sk] == ("CUST-000064", "Consumer")
    assert segment[got["OL-3"].customer_sk][0] == "UNKNOWN"
    assert got["OL-3"].product_sk is None and got["OL-3"].cogs is None
    one = got["OL-00004217"]
    assert (one.cogs, one.gross_profit, one.date_key) == (Decimal("30.03"), Decimal("1.48"), 20230519)
    regions = gold.dim_region(silver.region_map(spark, REGION_SPELLINGS))
    channels = gold.dim_channel(o)
    # Keys derived from the text are the keys a lookup would find.
    assert plain.join(regions, "region_sk", "left_anti").count() == 0
    assert plain.join(channels, "channel_sk", "left_anti").count() == 0


def test_fact_gl_unknown_region_has_no_key(spark):
    regions = gold.dim_region(silver.region_map(spark, REGION_SPELLINGS))
    gl = spark.createDataFrame(
        [("G1", dt.date(2023, 5, 28), dt.date(2023, 5, 1), "4000", "n", "West", "c", Decimal(-5)), ("G2", dt.date(2023, 5, 28), dt.date(2023, 5, 1), "4000", "n", "Mars", "c", Decimal(-5))],
        "gl_id string, posting_date date, posting_month date, account_code string, account_name string, region string, cost_center string, amount_usd decimal(18,4)",
    )
    got = {r.gl_id: r for r in gold.fact_gl(gl, regions).collect()}
    assert got["G1"].region_sk and got["G2"].region_sk is None and got["G1"].date_key == 20230528


def test_upsert_and_watermark(spark):
    old = spark.createDataFrame([("a", 1, LOADED), ("b", 2, LOADED)], "id string, v int, _loaded_at timestamp")
    new = spark.createDataFrame([("b", 20, LOADED, "x"), ("c", 3, LOADED, "y")], "id string, v int, _loaded_at timestamp, w string")
    once = upsert(old, new, ["id"])
    assert sorted((r.id, r.v, r.w) for r in once.collect()) == [("a", 1, None), ("b", 20, "x"), ("c", 3, "y")]
    assert rows(upsert(once, new, ["id"])) == rows(once)
    assert newer_than(old, read_watermark(old)).count() == 0  # strictly newer
    assert newer_than(old, read_watermark(None)).count() == 2
    assert newer_than(old, read_watermark(old.limit(0))).count() == 2


def test_bridge_prior_month_is_the_previous_present(spark):
    rows_ = [("2023-03-10", "100.00"), ("2023-06-10", "150.00")]
    lines = [GOOD | {"order_line_id": f"OL-{i}", "order_date": d, "net_revenue": n} for i, (d, n) in enumerate(rows_)]
    o, dc, dp = warehouse(spark, *lines)
    dates = gold.dim_date(cal.date_spine(spark, cal.SPINE_START, cal.SPINE_END))
    got = marts.monthly_revenue_bridge(gold.fact_sales(o, dc, dp), dates).orderBy("month_start").collect()
    assert got[0].prior_net_revenue is None and got[1].prior_net_revenue == Decimal("100.00")
    assert got[1].mom_change_pct == Decimal("50.00")
    margin = marts.gross_margin_by_segment(gold.fact_sales(o, dc, dp), dc, dates).collect()
    assert [(r.fiscal_year, r.customer_segment, r.order_lines, r.active_customers) for r in margin] == [(2023, "SMB", 2, 1)]
    cohort = marts.customer_cohort_retention(gold.fact_sales(o, dc, dp), dc).orderBy("period_number").collect()
    assert [(r.period_number, r.active_customers, r.cohort_size, r.retention_pct) for r in cohort] == [(0, 1, 1, 100), (3, 1, 1, 100)]


def test_days_outside_the_calendar_leave_the_marts(spark):
    o, dc, dp = warehouse(spark, GOOD)
    short = gold.dim_date(cal.date_spine(spark, dt.date(2022, 1, 1), dt.date(2022, 2, 1)))
    assert marts.monthly_revenue_bridge(gold.fact_sales(o, dc, dp), short).count() == 0


def test_contract_scales():
    assert CONTRACTS["fx_rates"].columns[3].scale == 9


def test_lines_are_dealt_to_tasks_by_rows(spark, tmp_path, monkeypatch):
    """Silver sorts the wide lines in the tasks of the order lookup: none may hold most of them."""
    ids = spark.range(0, 2000, 1, 4)
    tables = {
        "region": spark.createDataFrame([(0, "ASIA")], "r_regionkey bigint, r_name string"),
        "nation": spark.createDataFrame([(0, 0)], "n_nationkey bigint, n_regionkey bigint"),
        "customer": ids.selectExpr("id AS c_custkey", "0L AS c_nationkey"),
        "part": ids.selectExpr("id AS p_partkey", "id / 4 AS p_retailprice"),
        "orders": ids.selectExpr("id AS o_orderkey", "id AS o_custkey", "DATE'1996-03-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority"),
        "lineitem": ids.selectExpr(
            "id AS l_orderkey", "explode(sequence(1, 3)) AS l_linenumber", "1999 - id AS l_partkey", "id % 50 AS l_suppkey",
            "5 AS l_quantity", "0.05 AS l_discount", "'N' AS l_returnflag",
        ),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(joins, "TASK_ROWS", 100, raising=False)
    monkeypatch.setattr(joins, "rows_within", lambda df, limit: df.count() < 100)
    lines = testbed.raw_pos_orders(spark, str(tmp_path))
    held = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 6000 and max(held) <= 300
    assert lines.where("unit_price = (1999 - cast(substring(order_id, 5) AS int)) / 4").count() == 6000


def test_lines_carry_starts_only_where_keys_follow_from_them(spark):
    lost = GOOD | {"order_line_id": "OL-3", "customer_id": "", "product_id": "PROD-9999"}
    o, dc, dp = warehouse(spark, GOOD, GOOD | {"order_line_id": "OL-2", "order_date": "2023-01-31"}, lost)
    lines = gold.fact_lines(o, dc, dp)
    assert {"_customer_from", "_product_from"} < set(lines.columns) and not {"customer_sk", "product_sk"} & set(lines.columns)
    numbered = dc.withColumn("customer_sk", F.concat(F.lit("C"), "customer_sk"))
    assert "customer_sk" in gold.fact_lines(o, numbered, dp).columns
    got = gold.fact_sales(o, numbered, dp).withColumn("customer_sk", F.expr("substring(customer_sk, 2)"))
    assert rows(got) == rows(gold.fact_sales(o, dc, dp))
