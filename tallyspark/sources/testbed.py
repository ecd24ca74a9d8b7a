"""The five raw feeds derived from a TPC-H-like star schema.

Every column is text, as landed, plus load metadata. Only integer and decimal
arithmetic is used, so another engine can derive the same feeds exactly. Dirt that
silver must repair is built in: repeated lines, odd region spellings, missing
customers, returns, a missing exchange rate and reloaded extracts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.calendar import month_start
from tallyspark.functions.casting import cents
from tallyspark.operators.joins import lookup_join
from tallyspark.sources.contracts import CONTRACTS, FeedContract

# Fixed values of the driver's tables.
REGION_NAMES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SEGMENT_NAMES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
EXTRACTS = (dt.date(1995, 1, 1), dt.date(1997, 1, 1), dt.date(1999, 1, 1))
SPINE = (dt.date(1994, 2, 1), dt.date(2003, 2, 1))
RELOADED_EXTRACT = dt.date(1997, 1, 1)
MISSING_RATE_MONTH = dt.date(1996, 2, 1)

ACCOUNT_NAMES = {
    "4000": "Product Revenue",
    "5000": "Cost of Goods Sold",
    "6000": "Selling Expense",
    "6100": "Marketing Expense",
    "6200": "General Expense",
}
OPEX_PERCENT = {"6000": 18, "6100": 6, "6200": 4}


def region_spellings() -> list[tuple[str, str]]:
    """(spelling, name) the seed map knows: the name, lower case, two letters and a dot."""
    return [(raw, name) for name in REGION_NAMES for raw in (name, name.lower(), name[:2] + ".")]


_window = {"min": "1995-01-01", "max": "2001-12-31"}
_extracts = {"min": "1995-01-01", "max": "1999-01-01"}

CONTRACTS_HERE: dict[str, FeedContract] = {
    "pos_orders": CONTRACTS["pos_orders"].with_rules(
        order_line_id={"regex": r"^OL-\d{8}-\d+$"},
        order_id={"regex": r"^ORD-\d{8}$"},
        order_date=_window,
        customer_id={"regex": r"^(CUST-\d{7}| *)$"},
        product_id={"regex": r"^PROD-\d{7}$"},
    ),
    "gl_extract": CONTRACTS["gl_extract"].with_rules(
        gl_id={"regex": r"^GL-[0-9a-f]{16}$"}, posting_date=_window, region={"allowed": (*REGION_NAMES, "Unknown")}
    ),
    "customer_master": CONTRACTS["customer_master"].with_rules(
        extract_date=_extracts,
        customer_id={"regex": r"^CUST-\d{7}$"},
        customer_segment={"allowed": SEGMENT_NAMES},
        region={"allowed": REGION_NAMES},
        signup_date={"min": "1994-01-01", "max": "1995-12-31"},
    ),
    "product_master": CONTRACTS["product_master"].with_rules(
        extract_date=_extracts, product_id={"regex": r"^PROD-\d{7}$"}, category={"allowed": PART_TYPES}
    ),
    "fx_rates": CONTRACTS["fx_rates"].with_rules(rate_date=_window),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text_id(prefix: str, key: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), width, "0"))


def _batch(label: Column) -> Column:
    return F.substring(F.md5(label), 1, 16)


def _next_of(col: Column, names: tuple[str, ...]) -> Column:
    """The following name, wrapping around."""
    following = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, names[(i + 1) % len(names)])])
    return following[col]


def _as_text(df: DataFrame, contract: FeedContract) -> DataFrame:
    meta = ("_loaded_at", "_source_file", "_batch_id")
    texts = [F.col(n).cast("string").alias(n) for n in contract.names]
    return df.select(*texts, *meta, F.lit(contract.source_system).alias("_source_system"))


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions, nations, customers = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    placed = lookup_join(nations, regions, "n_regionkey", "r_regionkey", ["n_nationkey"], how="inner")
    places = placed.select("n_nationkey", "r_name")
    return lookup_join(customers, places, "c_nationkey", "n_nationkey", ["c_custkey"], how="inner", bound=nations)


def raw_pos_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a point-of-sale feed: one batch per order year."""
    buyers = customer_regions(spark, sf_dir).select("c_custkey", "r_name")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_orderpriority"
    )
    customers = table(spark, sf_dir, "customer")
    placed = lookup_join(orders, buyers, "o_custkey", "c_custkey", ["o_orderkey"], how="inner", bound=customers, base=orders)
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag"
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    item = ["l_orderkey", "l_linenumber", "l_suppkey"]
    # Prices first, while rows are narrow. Below, rows become a feed's text, which silver sorts in the same tasks.
    priced = lookup_join(items, parts, "l_partkey", "p_partkey", item, how="inner", base=items)
    lines = lookup_join(priced, placed, "l_orderkey", "o_orderkey", item, how="inner", bound=orders, base=items, by_rows=True)
    year = F.year("order_date")
    returned = (F.col("l_returnflag") == "R") & (F.col("l_suppkey") % 10 == 0)
    dirt = F.col("l_partkey") % 12
    level = F.substring("o_orderpriority", 1, 1)
    units = F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("bigint")
    feed = lines.withColumns(
        {
            "order_line_id": F.concat(_text_id("OL-", "l_orderkey", 8), F.lit("-"), F.col("l_linenumber").cast("string")),
            "order_id": _text_id("ORD-", "o_orderkey", 8),
            "customer_id": F.when(F.col("l_orderkey") % 331 == 0, F.lit(None))
            .when(F.col("l_orderkey") % 337 == 0, F.lit("  "))
            .otherwise(_text_id("CUST-", "o_custkey", 7)),
            "product_id": _text_id("PROD-", "l_partkey", 7),
            "region": F.when(dirt == 0, F.lower("r_name"))
            .when(dirt == 1, F.concat("r_name", F.lit(" ")))
            .when(dirt == 2, F.concat(F.lit(" "), F.col("r_name")))
            .when(dirt == 3, F.concat(F.substring("r_name", 1, 2), F.lit(".")))
            .when(dirt == 4, F.when(year % 2 == 0, F.lit("N/A")).otherwise(F.lit("Elsewhere")))
            .otherwise(F.col("r_name")),
            "channel": F.when(level.isin("1", "2"), F.lit("Online"))
            .when(level == "3", F.lit("Wholesale"))
            .otherwise(F.lit("Retail")),
            "quantity": units,
            "unit_price": F.col("p_retailprice").cast("decimal(18,2)"),
            "discount_pct": F.col("l_discount").cast("decimal(4,2)"),
            "currency": F.when(F.col("l_suppkey") % 7 == 0, F.lit("EUR")).otherwise(F.lit("USD")),
            "_loaded_at": F.make_timestamp(year + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)),
            "_source_file": F.concat(F.lit("pos_"), year.cast("string")),
            "_batch_id": _batch(year.cast("string")),
        }
    )
    gross = feed.withColumn("gross_revenue", (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)"))
    net = gross.withColumn("discount_amount", cents(F.col("gross_revenue") * F.col("discount_pct"))).withColumn(
        "net_revenue", (F.col("gross_revenue") - F.col("discount_amount")).cast("decimal(18,2)")
    )
    return _as_text(net, CONTRACTS_HERE["pos_orders"])


def spoiled_pos_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales feed with corrupt cells, one kind per product number ending."""
    ending = F.substring("product_id", -2, 2)

    def where(end: str, column: str, value: Column) -> Column:
        return F.when(ending == end, value).otherwise(F.col(column))

    day = F.col("order_date").cast("date")
    return raw_pos_orders(spark, sf_dir).withColumns(
        {
            "quantity": F.when(ending == "17", F.lit("abc"))
            .when(ending == "18", F.concat("quantity", F.lit(".0")))
            .when(ending == "16", F.concat("quantity", F.lit(".5")))
            .otherwise(F.col("quantity")),
            "order_date": F.when(ending == "19", F.lit("31/31/1999"))
            .when(ending == "20", F.date_format(day, "MM/dd/yyyy"))
            .when(ending == "26", F.lit("2019-01-01"))
            .otherwise(F.col("order_date")),
            "currency": F.when(ending == "21", F.lit("GBP")).when(ending == "27", F.lit("JPY")).otherwise(F.col("currency")),
            "discount_pct": where("23", "discount_pct", F.lit("1.5")),
            "unit_price": where("24", "unit_price", F.lit("-1")),
            "customer_id": where("25", "customer_id", F.lit("12345")),
            "product_id": where("22", "product_id", F.lit("null")),
        }
    )


def _extracts_of(df: DataFrame, feed: str) -> DataFrame:
    """One copy of a table per extract date, with its load metadata."""
    dates = F.explode(F.array(*[F.lit(d) for d in EXTRACTS]))
    dated = df.withColumn("extract_date", dates)
    label = F.concat(F.lit(f"{feed}_"), F.col("extract_date").cast("string"))
    return dated.withColumns(
        {
            "_loaded_at": F.date_add("extract_date", 1).cast("timestamp"),
            "_source_file": F.concat(label, F.lit(".csv")),
            "_batch_id": _batch(label),
        }
    )


def _with_reload(df: DataFrame, reload_rows: Column, column: str, feed: str) -> DataFrame:
    """Add a second, later load of part of one extract with an edited text column."""
    again = df.where((F.col("extract_date") == F.lit(RELOADED_EXTRACT)) & reload_rows)
    return df.unionByName(
        again.withColumns(
            {
                column: F.concat(F.trim(column), F.lit(" II")),
                "_loaded_at": F.date_add("extract_date", 2).cast("timestamp"),
                "_source_file": F.lit(f"{feed}_reload.csv"),
                "_batch_id": _batch(F.lit(f"{feed}_reload")),
            }
        )
    )


def raw_customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three customer extracts; some segments change from 1997, regions from 1999."""
    src = _extracts_of(customer_regions(spark, sf_dir), "customer_master")
    from_1997 = F.col("extract_date") >= F.lit(EXTRACTS[1])
    from_1999 = F.col("extract_date") >= F.lit(EXTRACTS[2])
    segment = F.col("c_mktsegment")
    region = F.col("r_name")
    feed = src.withColumns(
        {
            "customer_id": _text_id("CUST-", "c_custkey", 7),
            "customer_name": F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")),
            "customer_segment": F.when(
                (F.col("c_custkey") % 5 == 0) & from_1997, _next_of(segment, SEGMENT_NAMES)
            ).otherwise(segment),
            "region": F.when((F.col("c_custkey") % 7 == 0) & from_1999, _next_of(region, REGION_NAMES)).otherwise(region),
            "signup_date": F.date_add(F.lit(dt.date(1994, 1, 1)), (F.col("c_custkey") % 365).cast("int")),
        }
    )
    both = _with_reload(feed, F.col("c_custkey") % 11 == 0, "customer_name", "customer_master")
    return _as_text(both, CONTRACTS_HERE["customer_master"])


def raw_product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three product extracts with price, category and description changes."""
    src = _extracts_of(table(spark, sf_dir, "part"), "product_master")
    from_1997 = F.col("extract_date") >= F.lit(EXTRACTS[1])
    from_1999 = F.col("extract_date") >= F.lit(EXTRACTS[2])
    retail = F.col("p_retailprice").cast("decimal(18,2)")
    raised = cents(retail * F.lit("1.08").cast("decimal(3,2)"))
    feed = src.withColumns(
        {
            "product_id": _text_id("PROD-", "p_partkey", 7),
            "description": F.when(
                (F.col("p_partkey") % 100 == 1) & from_1999, F.concat("p_name", F.lit(" (rev)"))
            ).otherwise(F.col("p_name")),
            "category": F.when((F.col("p_partkey") % 50 == 0) & from_1997, F.lit("PROMO")).otherwise(F.col("p_type")),
            "subcategory": F.col("p_brand"),
            "list_price": F.when((F.col("p_partkey") % 40 == 0) & from_1999, raised).otherwise(retail),
            "standard_cost": cents(retail * F.lit("0.60").cast("decimal(3,2)")),
        }
    )
    both = _with_reload(feed, F.col("p_partkey") % 13 == 0, "description", "product_master")
    return _as_text(both, CONTRACTS_HERE["product_master"])


def raw_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EUR and USD into USD, and EUR into GBP, for every month with an order; one
    EUR month is left out."""
    months = (
        table(spark, sf_dir, "orders")
        .select(month_start(F.col("o_orderdate").cast("date")).alias("rate_date"))
        .distinct()
    )
    eur = (F.lit(105).cast("decimal(9,6)") + F.month("rate_date").cast("decimal(9,6)")) / 100
    pairs = F.array(
        F.struct(F.lit("EUR").alias("f"), F.lit("USD").alias("t"), eur.cast("decimal(18,6)").alias("r")),
        F.struct(F.lit("USD").alias("f"), F.lit("USD").alias("t"), F.lit(1).cast("decimal(18,6)").alias("r")),
        F.struct(F.lit("EUR").alias("f"), F.lit("GBP").alias("t"), F.lit("0.85").cast("decimal(18,6)").alias("r")),
    )
    rates = months.select("rate_date", F.inline(pairs)).where(
        ~((F.col("rate_date") == F.lit(MISSING_RATE_MONTH)) & (F.col("f") == "EUR") & (F.col("t") == "USD"))
    )
    feed = rates.select(
        "rate_date",
        F.col("f").alias("from_currency"),
        F.col("t").alias("to_currency"),
        F.col("r").alias("rate"),
        F.lit(dt.datetime(2002, 1, 1)).cast("timestamp").alias("_loaded_at"),
        F.lit("fx_rates.csv").alias("_source_file"),
        _batch(F.lit("fx_rates")).alias("_batch_id"),
    )
    return _as_text(feed, CONTRACTS_HERE["fx_rates"])


def raw_gl_extract(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Ledger postings summed from clean sales: revenue and cost per month, region
    and channel, operating expense per month and region."""
    costs = products.groupBy("product_id").agg(F.max_by("standard_cost", "extract_date").alias("standard_cost"))
    per_product = orders.groupBy("order_month", "region", "channel", "product_id").agg(
        F.sum("net_revenue_usd").alias("net"), F.sum("quantity").alias("units")
    )
    sums = (
        per_product.join(costs, "product_id")
        .groupBy("order_month", "region", "channel")
        .agg(F.sum("net").alias("net"), F.sum(cents(F.col("units") * F.col("standard_cost"))).alias("cogs"))
    )
    # One row per month and region holds its few channels, so that the lines are summed once for both kinds of posting.
    held = F.collect_list(F.struct("channel", "net", "cogs")).alias("channels")
    regional = sums.groupBy("order_month", "region").agg(held, F.sum("net").alias("net"))

    def entry(code: str, center: Column, amount: Column) -> Column:
        return F.struct(F.lit(code).alias("account_code"), center.alias("cost_center"), cents(amount).alias("amount"))

    revenue = F.transform("channels", lambda c: entry("4000", c["channel"], -c["net"]))
    cost = F.transform("channels", lambda c: entry("5000", c["channel"], c["cogs"]))
    opex = [entry(code, F.lit("Corporate"), F.col("net") * F.lit(pct) / F.lit(100)) for code, pct in OPEX_PERCENT.items()]
    posted = regional.select("order_month", "region", F.inline(F.concat(revenue, cost, F.array(*opex))))
    names = F.create_map(*[F.lit(x) for pair in ACCOUNT_NAMES.items() for x in pair])
    identity = F.concat_ws("|", F.col("order_month").cast("string"), "region", "account_code", "cost_center")
    feed = posted.select(
        F.concat(F.lit("GL-"), F.substring(F.md5(identity), 1, 16)).alias("gl_id"),
        F.date_add("order_month", 27).alias("posting_date"),
        "account_code",
        names[F.col("account_code")].alias("account_name"),
        "region",
        "cost_center",
        F.col("amount").alias("amount_usd"),
        F.lit("USD").alias("currency"),
        F.lit("ERP").alias("source_system"),
        F.lit(dt.datetime(2002, 1, 1)).cast("timestamp").alias("_loaded_at"),
        F.lit("gl_extract.csv").alias("_source_file"),
        _batch(F.lit("gl_extract")).alias("_batch_id"),
    )
    return _as_text(feed, CONTRACTS_HERE["gl_extract"])


# Events of the driver's tables as tools of an access log.
EVENT_TOOLS = {"click": "query_metric", "view": "preview", "purchase": "run_query", "signup": "list_tables"}
METRIC_NAMES = (
    "net_revenue", "gross_margin_pct", "average_order_value", "customer_count", "revenue_per_customer", "gl_expense_total",
)


def audit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON log lines (column ``value``), some malformed, some of other
    kinds."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    tool = F.lit("query_metric")
    for event, name in EVENT_TOOLS.items():
        tool = F.when(F.col("event_type") == event, F.lit(name)).otherwise(tool)
    denied = F.col("event_type") == "error"
    metric = F.element_at(F.array(*[F.lit(m) for m in METRIC_NAMES]), (F.col("k") % 6 + 1).cast("int"))
    line = F.to_json(
        F.struct(
            F.when(F.col("event_id") % 89 == 0, F.lit("startup")).otherwise(F.lit("tool_call")).alias("event"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            F.lit("info").alias("level"),
            tool.alias("tool"),
            F.struct(metric.alias("metric")).alias("arguments"),
            F.when(denied, F.lit("deny")).otherwise(F.lit("allow")).alias("decision"),
            F.when(denied, F.concat(F.lit("reason "), (F.col("k") % 7).cast("string"))).otherwise(F.lit("ok")).alias("reason"),
            F.when(~denied, F.col("k")).alias("rows"),
            F.col("value").alias("latency_ms"),
        )
    )
    return e.select(F.when(F.col("event_id") % 97 == 0, F.lit("not a json line {")).otherwise(line).alias("value"))


# Statements a log may hold; @ stands for an event id.
STATEMENTS = (
    "SELECT channel_sk, count(*) AS n FROM gold.fact_sales WHERE date_key > @ GROUP BY channel_sk",
    "WITH big AS (SELECT * FROM gold.fact_gl WHERE amount_usd > @) SELECT account_code, count(*) FROM big GROUP BY 1",
    "SELECT @ AS a; SELECT 2 AS b",
    "SELECT @ /* first; */ ; -- second\n SELECT 3 AS c;",
    "/* @ */ TRUNCATE gold.dim_region",
    "DESCRIBE gold.dim_date -- @",
    "WITH old AS (SELECT @ AS k) MERGE INTO gold.dim_product USING old ON true",
    "SELECT max(x) FROM (VALUES (@)) AS t(x) WHERE 'revoke' <> 'grant'",
    "VACUUM gold.fact_sales -- @",
    "SELECT n FROM read_parquet('part-@.parquet')",
    "SELECT line FROM Read_Text('log-@')",
    "\n\n\tWith t AS (SELECT @ AS i) Select i FROM t;",
    "-- @ was here\n/* and left */",
    "\t\n ",
    "SELECT 'we load at @' AS note",
    "SELECT uploaded_@, recreated FROM gold.fact_gl",
    "SELECT d.*, '/* @ */' AS stars FROM gold.dim_date d",
    "SELECT @ -- one\nFROM gold.dim_channel /* two\nthree */ LIMIT 4",
    ";;; ;",
    "CREATE VIEW v@ AS SELECT 1",
    "SELECT @ AS a -- /* one\n; SELECT 2 AS b */",
)


def logged_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logged statement per event: (event_id, sql)."""
    shapes = F.array(*[F.lit(s) for s in STATEMENTS])
    shape = F.element_at(shapes, (F.col("event_id") % len(STATEMENTS) + 1).cast("int"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.replace(shape, F.lit("@"), F.col("event_id").cast("string")).alias("sql")
    )
