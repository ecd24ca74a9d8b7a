"""DuckDB statement for every registered query."""

from __future__ import annotations

from oracle import suite
from oracle.sql import CTES, statement

SELECTS: dict[str, str] = {}


def text(*names: str) -> str:
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)


def double(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def integer(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


# Landing

LOADED = "SELECT DISTINCT substr(md5(CAST(year(o_orderdate) AS VARCHAR)), 1, 16) FROM orders WHERE year(o_orderdate) <= 1997"

SELECTS["bronze_stamp_metadata"] = """
SELECT o_orderkey, '2002-01-01 00:00:00' AS _loaded_at, 'orders.parquet' AS _source_file,
       substr(sha256('orders.parquet/' || CAST(o_orderkey AS VARCHAR)), 1, 16) AS _batch_id, 'POS' AS _source_system FROM orders"""
SELECTS["bronze_batch_id"] = "SELECT doc_id, substr(sha256(text), 1, 16) AS batch_id FROM documents"
SELECTS["bronze_idempotent_append"] = f"""
SELECT _batch_id, _source_file, count(*) AS rows FROM raw_pos WHERE _batch_id NOT IN ({LOADED}) GROUP BY ALL"""
SELECTS["bronze_gate"] = """
SELECT _source_file AS file, count(*) AS rows FROM raw_pos GROUP BY 1 HAVING count_if(region = 'N/A') = 0"""
SELECTS["bronze_landing_plan"] = f"""
SELECT _source_file AS file, _batch_id AS batch_id, count(*) AS rows, 'raw_pos_orders' AS target,
       CASE WHEN _batch_id IN ({LOADED}) THEN 'skip' ELSE 'load' END AS action FROM raw_pos GROUP BY ALL"""
SELECTS["seed_region_map"] = """
SELECT spelling, region_canonical, lines
FROM (SELECT trim(region) AS spelling, count(*) AS lines FROM raw_pos GROUP BY 1) s LEFT JOIN region_map ON spelling = raw_region"""

# Gate

CTES["spoiled"] = """
SELECT _source_file AS file, order_line_id, order_id, right(product_id, 2) AS ending,
       CASE WHEN right(product_id, 2) = '22' THEN NULL ELSE product_id END AS product_id,
       CASE right(product_id, 2) WHEN '25' THEN '12345' ELSE customer_id END AS customer_id,
       nullif(region, 'N/A') AS region
FROM raw_pos"""


def _counted(column: str, rule: str, condition: str) -> str:
    return (
        f"SELECT 'pos_orders' AS feed, file, '{column}' AS \"column\", '{rule}' AS rule, 'error' AS severity, "
        f"count_if({condition}) AS n FROM spoiled GROUP BY file HAVING count_if({condition}) > 0"
    )


SELECTS["gate_dtype"] = (
    _counted("quantity", "dtype", "ending IN ('16', '17')") + " UNION ALL " + _counted("order_date", "dtype", "ending = '19'")
)
SELECTS["gate_not_null"] = (
    _counted("product_id", "not_null", "product_id IS NULL") + " UNION ALL " + _counted("region", "not_null", "region IS NULL")
)
SELECTS["gate_accepted_values"] = """
SELECT 'pos_orders' AS feed, file, 'currency' AS "column", 'accepted_values' AS rule, 'error' AS severity, count(*) AS n,
       'outside the accepted values: ' || string_agg(DISTINCT CASE ending WHEN '21' THEN 'GBP' ELSE 'JPY' END, ', '
         ORDER BY CASE ending WHEN '21' THEN 'GBP' ELSE 'JPY' END) AS detail
FROM spoiled WHERE ending IN ('21', '27') GROUP BY file"""
SELECTS["gate_range"] = " UNION ALL ".join(
    (
        _counted("discount_pct", "max", "ending = '23'"),
        _counted("unit_price", "min", "ending = '24'"),
        _counted("order_date", "max", "ending = '26'"),
    )
)
SELECTS["gate_regex"] = _counted("customer_id", "regex", "NOT regexp_full_match(customer_id, '(CUST-[0-9]{7}| *)')")
SELECTS["gate_unique"] = " UNION ALL ".join(
    f"SELECT 'pos_orders' AS feed, file, '{c}' AS \"column\", 'unique' AS rule, 'error' AS severity, "
    f"count({c}) - count(DISTINCT {c}) AS n FROM spoiled GROUP BY file HAVING count({c}) > count(DISTINCT {c})"
    for c in ("order_line_id", "product_id")
)
SELECTS["gate_primary_key"] = """
SELECT 'pos_orders' AS feed, file, 'order_id+product_id' AS "column", 'primary_key_unique' AS rule, 'error' AS severity,
       count(*) - count(DISTINCT order_id || '/' || coalesce(product_id, '')) AS n
FROM spoiled GROUP BY file HAVING count(*) > count(DISTINCT order_id || '/' || coalesce(product_id, ''))"""
SELECTS["gate_verdict"] = """
SELECT *, errors = 0 AS passed FROM (
  SELECT 'pos_orders' AS feed, _source_file AS file, count(*) AS rows, CAST(count_if(region = 'N/A') > 0 AS BIGINT) AS errors,
         CAST(0 AS BIGINT) AS warnings FROM raw_pos GROUP BY 2
  UNION ALL SELECT 'customer_master', _source_file, count(*), 0, 0 FROM bronze_customers GROUP BY 2
  UNION ALL SELECT 'product_master', _source_file, count(*), 0, 0 FROM bronze_products GROUP BY 2
  UNION ALL SELECT 'fx_rates', _source_file, count(*), CAST(count_if(to_currency = 'GBP') > 0 AS BIGINT), 0 FROM bronze_fx GROUP BY 2
  UNION ALL SELECT 'gl_extract', _source_file, count(*), 0, 0 FROM bronze_gl GROUP BY 2) v"""
SELECTS["gate_columns"] = """
SELECT 'pos_orders' AS feed, file, unnest(['currency', 'currency_code']) AS "column",
       unnest(['missing_column', 'unexpected_column']) AS rule, 'error' AS severity
FROM (SELECT DISTINCT file FROM spoiled) s"""
SELECTS["gate_boolean"] = """
SELECT 'flags' AS feed, l_returnflag AS file, 'flag' AS "column", 'dtype' AS rule, 'error' AS severity, count(*) AS n
FROM lineitem WHERE l_partkey % 6 IN (3, 4) GROUP BY l_returnflag"""
SELECTS["landing_files"] = """
SELECT CAST(extract_date AS VARCHAR) AS extract_date, customer_id, customer_name, customer_segment, region,
       CAST(signup_date AS VARCHAR) AS signup_date, '2002-01-01' AS landed FROM bronze_customers"""
SELECTS["landing_quoted"] = "SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang FROM documents"
SELECTS["landing_malformed"] = """
SELECT c_custkey % 5 AS kind, CASE c_custkey % 5 WHEN 0 THEN 'append' ELSE 'reject' END AS action,
       CASE c_custkey % 5 WHEN 0 THEN '' WHEN 3 THEN 'duplicate_column' WHEN 4 THEN 'dtype' WHEN 2 THEN 'malformed_row,not_null' ELSE 'malformed_row' END AS reason,
       CASE WHEN c_custkey % 5 <> 3 THEN count(*) END AS rows FROM customer GROUP BY 1, 2, 3, c_custkey % 5"""

# Bronze and silver

SELECTS["bronze_typed"] = f"""
SELECT order_line_id, order_id, {text('order_date')}, customer_id, product_id, region, channel, quantity,
       {double('unit_price', 'discount_pct', 'gross_revenue', 'discount_amount', 'net_revenue')}, currency,
       {text('_loaded_at')}, _source_file, _batch_id, _source_system FROM bronze_pos"""
SELECTS["bronze_typed_gl"] = f"""
SELECT gl_id, {text('posting_date')}, account_code, account_name, region, cost_center, {double('amount_usd')}, currency,
       source_system, {text('_loaded_at')}, _source_file, _batch_id, _source_system FROM bronze_gl"""
SELECTS["bronze_typed_customers"] = f"""
SELECT {text('extract_date')}, customer_id, customer_name, customer_segment, region, {text('signup_date', '_loaded_at')},
       _source_file, _batch_id, _source_system FROM bronze_customers"""
SELECTS["bronze_typed_products"] = f"""
SELECT {text('extract_date')}, product_id, description, category, subcategory, {double('list_price', 'standard_cost')},
       {text('_loaded_at')}, _source_file, _batch_id, _source_system FROM bronze_products"""
SELECTS["bronze_typed_fx"] = f"""
SELECT {text('rate_date')}, from_currency, to_currency, {double('rate')}, {text('_loaded_at')}, _source_file, _batch_id,
       _source_system FROM bronze_fx"""
SELECTS["silver_orders_dedup"] = f"""
SELECT order_line_id, product_id, quantity, {double('net_revenue')}, currency, _batch_id FROM orders_deduped"""
SELECTS["silver_latest_wins"] = f"""
SELECT customer_id, {text('extract_date')}, trim(customer_name, '') AS customer_name, _source_file
FROM (SELECT * FROM bronze_customers
      QUALIFY row_number() OVER (PARTITION BY customer_id, extract_date ORDER BY _loaded_at DESC) = 1) l"""
SELECTS["silver_region_conform"] = """
SELECT b.region AS region_raw, coalesce(m.region_canonical, 'Unknown') AS region, count(*) AS lines
FROM bronze_pos b LEFT JOIN region_map m ON trim(b.region) = m.raw_region GROUP BY ALL"""
SELECTS["silver_unknown_customer"] = """
SELECT coalesce(nullif(trim(customer_id), ''), 'UNKNOWN') AS customer_id,
       customer_id IS NULL OR trim(customer_id) = '' AS is_unknown_customer, count(*) AS lines FROM bronze_pos GROUP BY 1, 2"""
SELECTS["silver_fx_convert"] = """
SELECT CAST(order_month AS VARCHAR) AS order_month, currency, CAST(r AS DOUBLE) AS fx_rate_to_usd,
       CAST(sum(round(gross_revenue * r, 2)) AS DOUBLE) AS gross_revenue_usd,
       CAST(sum(round(discount_amount * r, 2)) AS DOUBLE) AS discount_amount_usd,
       CAST(sum(round(net_revenue * r, 2)) AS DOUBLE) AS net_revenue_usd
FROM (SELECT b.*, CAST(date_trunc('month', order_date) AS DATE) AS order_month, coalesce(rate, CAST(1 AS DECIMAL(18,9))) AS r
      FROM bronze_pos b LEFT JOIN silver_fx x ON x.rate_month = CAST(date_trunc('month', b.order_date) AS DATE)
        AND x.from_currency = b.currency AND x.to_currency = 'USD') p GROUP BY 1, 2, 3"""
SELECTS["silver_orders"] = f"""
SELECT order_line_id, order_id, {text('order_date', 'order_month')}, customer_id, is_unknown_customer, product_id, region,
       region_raw, channel, quantity, is_return, currency,
       {double('unit_price', 'discount_pct', 'gross_revenue', 'discount_amount', 'net_revenue', 'fx_rate_to_usd',
               'gross_revenue_usd', 'discount_amount_usd', 'net_revenue_usd')},
       {text('_loaded_at')}, _source_file, _batch_id FROM silver_orders"""
SELECTS["silver_customers"] = f"""
SELECT customer_id, {text('extract_date')}, customer_name, customer_segment, region, {text('signup_date', '_loaded_at')},
       _source_file, _batch_id FROM silver_customers"""
SELECTS["silver_products"] = f"""
SELECT product_id, {text('extract_date')}, description, category, subcategory, {double('list_price', 'standard_cost')},
       {text('_loaded_at')}, _source_file, _batch_id FROM silver_products"""
SELECTS["silver_gl"] = f"""
SELECT gl_id, {text('posting_date', 'posting_month')}, account_code, account_name, region, cost_center, {double('amount_usd')},
       currency, source_system, {text('_loaded_at')}, _source_file, _batch_id FROM silver_gl"""
SELECTS["silver_fx_rates"] = f"SELECT {text('rate_month')}, from_currency, to_currency, {double('rate')} FROM silver_fx"

# Dimensions

SELECTS["surrogate_key"] = """
SELECT c_custkey, md5(c_name || '-' || coalesce(CAST(nullif(c_nationkey, 0) AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS sk
FROM customer"""
SELECTS["date_spine"] = """
SELECT CAST(date_day AS VARCHAR) AS date_day, coalesce(n, 0) AS orders
FROM data_calendar LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) o ON d = date_day"""
SELECTS["dim_date"] = f"SELECT * REPLACE ({text('date_day')}) FROM data_dim_date"
SELECTS["fiscal_calendar"] = """
SELECT fiscal_year, fiscal_year_label, fiscal_quarter, fiscal_month, count(*) AS orders
FROM orders JOIN data_dim_date ON CAST(o_orderdate AS DATE) = date_day GROUP BY ALL"""
SELECTS["dim_channel"] = "SELECT * FROM dim_channel"
SELECTS["dim_region"] = """
SELECT d.region_sk, d.region_name, coalesce(lines, 0) AS lines
FROM dim_region d LEFT JOIN (SELECT region, count(*) AS lines FROM silver_orders GROUP BY 1) s ON s.region = d.region_name"""
SELECTS["scd2_changes"] = f"""
SELECT customer_id, {text('extract_date')}, customer_segment, region, is_first FROM customer_starts"""
SELECTS["scd2_windows"] = f"""
SELECT customer_id, customer_name, customer_segment, region, {text('signup_date', 'valid_from', 'valid_to')}
FROM customer_windows"""
SELECTS["dim_customer"] = f"""
SELECT customer_sk, customer_id, customer_name, customer_segment, region, {text('signup_date', 'valid_from', 'valid_to')},
       is_current FROM dim_customer"""
SELECTS["snapshot_as_of"] = f"""
SELECT product_id, {text('extract_date')}, description, category, subcategory, {double('list_price', 'standard_cost')}
FROM silver_products WHERE extract_date = DATE '1997-01-01'"""
_SNAPSHOT = f"""
SELECT product_id, description, category, subcategory, {double('list_price', 'standard_cost')},
       {text('extract_date', 'valid_from', 'valid_to')} FROM product_snapshot"""
SELECTS["snapshot_check"] = _SNAPSHOT
SELECTS["product_snapshot"] = _SNAPSHOT
SELECTS["scd1_overlay"] = """
SELECT s.product_id, CAST(s.valid_from AS VARCHAR) AS valid_from, n.description
FROM product_snapshot s JOIN newest_description n ON s.product_id = n.product_id"""
SELECTS["dim_product"] = f"""
SELECT product_sk, product_id, description, category, subcategory, {double('list_price', 'standard_cost')},
       {text('valid_from', 'valid_to')}, is_current FROM dim_product"""

# Facts

SELECTS["fact_sales"] = f"""
SELECT order_line_id, order_id, date_key, {text('order_date')}, customer_sk, product_sk, region_sk, channel_sk, is_return,
       is_unknown_customer, currency, quantity,
       {double('fx_rate_to_usd', 'gross_revenue', 'discount_amount', 'net_revenue', 'cogs', 'gross_profit')},
       {text('_loaded_at')} FROM fact_sales"""
SELECTS["fact_gl"] = f"""
SELECT gl_id, date_key, {text('posting_date', 'posting_month')}, region_sk, account_code, account_name, cost_center,
       {double('amount_usd')} FROM fact_gl"""
SELECTS["point_in_time_join"] = f"""
SELECT o.order_line_id, CAST(o.order_date AS VARCHAR) AS order_date, o.customer_id, c.customer_sk
FROM silver_orders o LEFT JOIN dim_customer c
  ON o.customer_id = c.customer_id AND o.order_date >= c.valid_from AND o.order_date < c.valid_to"""
SELECTS["incremental_watermark"] = f"""
SELECT {text('_loaded_at')}, count(*) AS lines, CAST(sum(net_revenue_usd) AS DOUBLE) AS net_revenue_usd
FROM silver_orders
WHERE _loaded_at > (SELECT max(_loaded_at) FROM silver_orders WHERE _loaded_at <= TIMESTAMP '1999-01-01') GROUP BY silver_orders._loaded_at"""
SELECTS["upsert"] = f"""
SELECT order_line_id, quantity + CASE WHEN _loaded_at >= TIMESTAMP '1999-01-01' THEN 100 ELSE 0 END AS quantity,
       {double('net_revenue')}, {text('_loaded_at')} FROM fact_sales"""

# Marts

SELECTS["revenue_composition"] = f"""
SELECT {text('month_start')}, fiscal_year, fiscal_month, fiscal_year_label,
       {double('gross_sales', 'discounts', 'sales_net', 'returns', 'net_revenue', 'cogs', 'gross_profit')}, order_lines
FROM composition"""
SELECTS["revenue_period"] = f"""
SELECT {text('month_start')}, {double('net_revenue', 'prior_net_revenue', 'mom_change', 'mom_change_pct', 'gross_margin_pct')}
FROM bridge"""
SELECTS["monthly_revenue_bridge"] = f"""
SELECT {text('month_start')}, fiscal_year, fiscal_year_label, fiscal_month,
       {double('gross_sales', 'discounts', 'sales_net', 'returns', 'net_revenue', 'prior_net_revenue', 'mom_change',
               'mom_change_pct', 'cogs', 'gross_profit', 'gross_margin_pct')}, order_lines FROM bridge"""
SELECTS["gross_margin_by_segment"] = f"""
SELECT fiscal_year, fiscal_year_label, customer_segment, order_lines, active_customers,
       {double('net_revenue', 'cogs', 'gross_profit', 'gross_margin_pct')} FROM segment_margin"""
SELECTS["cohort_first_purchase"] = f"SELECT customer_id, {text('cohort_month')} FROM first_purchase"
SELECTS["cohort_periods"] = f"SELECT customer_id, {text('cohort_month')}, period_number FROM periods"
SELECTS["customer_cohort_retention"] = f"""
SELECT {text('cohort_month')}, cohort_size, period_number, active_customers, {double('retention_pct')} FROM retention"""

# Metrics

_VALUES = {
    "net_revenue": "sum(f.net_revenue)",
    "gross_margin_pct": "round(CAST(100 * sum(f.gross_profit) / nullif(sum(f.net_revenue), 0) AS DECIMAL(38,6)), 2)",
    "average_order_value": "round(CAST(sum(f.net_revenue) / nullif(count(DISTINCT f.order_id), 0) AS DECIMAL(38,6)), 2)",
    "customer_count": "count(DISTINCT c.customer_id)",
    "revenue_per_customer": "round(CAST(sum(f.net_revenue) / nullif(count(DISTINCT c.customer_id), 0) AS DECIMAL(38,6)), 2)",
    "gl_expense_total": "sum(f.amount_usd)",
}
_DIMENSIONS = {
    "region": "r.region_name",
    "channel": "ch.channel_name",
    "customer_segment": "c.customer_segment",
    "product_category": "p.category",
    "fiscal_year": "d.fiscal_year",
    "fiscal_quarter": "d.fiscal_quarter",
    "fiscal_month": "d.fiscal_month",
    "cost_center": "f.cost_center",
    "account_name": "f.account_name",
}
_SALES = """fact_sales f LEFT JOIN dim_region r ON f.region_sk = r.region_sk LEFT JOIN dim_channel ch ON f.channel_sk = ch.channel_sk
LEFT JOIN dim_customer c ON f.customer_sk = c.customer_sk LEFT JOIN dim_product p ON f.product_sk = p.product_sk
LEFT JOIN dim_date d ON f.date_key = d.date_key"""
_LEDGER = "fact_gl f LEFT JOIN dim_region r ON f.region_sk = r.region_sk LEFT JOIN dim_date d ON f.date_key = d.date_key"


def _metric(name: str, dims: list[str], where: str = "true") -> str:
    ledger = name == "gl_expense_total"
    if ledger:
        where += " AND f.account_code IN ('6000', '6100', '6200')"
    kind = "BIGINT" if name == "customer_count" else "DOUBLE"
    slices = "".join(f"{_DIMENSIONS[d]} AS {d}, " for d in dims)
    grouped = "GROUP BY " + ", ".join(_DIMENSIONS[d] for d in dims) if dims else ""
    return f"SELECT {slices}CAST({_VALUES[name]} AS {kind}) AS {name}\nFROM {_LEDGER if ledger else _SALES}\nWHERE {where} {grouped}"


SELECTS |= {
    "metric_net_revenue": _metric("net_revenue", ["region", "channel"]),
    "metric_gross_margin_pct": _metric("gross_margin_pct", ["fiscal_year", "customer_segment"]),
    "metric_average_order_value": _metric("average_order_value", ["region", "product_category"]),
    "metric_customer_count": _metric("customer_count", ["fiscal_year", "region"]),
    "metric_revenue_per_customer": _metric("revenue_per_customer", ["fiscal_year", "customer_segment", "channel"]),
    "metric_gl_expense_total": _metric("gl_expense_total", ["fiscal_year", "region", "account_name"]),
    "metric_by_region": _metric("net_revenue", ["region"]),
    "metric_by_channel": _metric("average_order_value", ["channel"]),
    "metric_by_customer_segment": _metric("customer_count", ["customer_segment"]),
    "metric_by_product_category": _metric("gross_margin_pct", ["product_category"]),
    "metric_by_fiscal_year": _metric("revenue_per_customer", ["fiscal_year"]),
    "metric_by_fiscal_quarter": _metric("net_revenue", ["fiscal_quarter"]),
    "metric_by_fiscal_month": _metric("net_revenue", ["fiscal_month"]),
    "metric_by_cost_center": _metric("gl_expense_total", ["cost_center"]),
    "metric_by_account_name": _metric("gl_expense_total", ["fiscal_year", "fiscal_month", "account_name"]),
    "metric_filtered": _metric(
        "net_revenue",
        ["fiscal_year", "fiscal_month", "channel"],
        "r.region_name = 'ASIA' AND NOT f.is_return AND f.currency = 'USD' AND d.fiscal_year = 1997 AND c.customer_segment = 'BUILDING'",
    ),
    "metric_filtered_average": _metric(
        "average_order_value", ["fiscal_year", "region"], "p.category = 'PROMO' AND ch.channel_name = 'Online' AND f.is_return"
    ),
    "metric_filtered_gl": _metric(
        "gl_expense_total", ["fiscal_year", "fiscal_quarter", "region"], "f.account_code = '6100' AND d.fiscal_year = 1998"
    ),
    "metric_filter_in": _metric("customer_count", ["fiscal_year", "channel"], "r.region_name IN ('ASIA', 'EUROPE')"),
    "metric_time_grain": _metric("net_revenue", ["fiscal_year", "fiscal_quarter", "region"]),
    "metric_default_grain": _metric("average_order_value", ["fiscal_year", "fiscal_quarter"]),
    "metric_month_grain": _metric("gross_margin_pct", ["fiscal_year", "fiscal_month"]),
}

# Profile

_TABLES = {
    "dim_customer": "dim_customer", "dim_product": "dim_product", "dim_date": "dim_date", "dim_region": "dim_region",
    "dim_channel": "dim_channel", "fact_sales": "fact_sales", "fact_gl": "fact_gl", "monthly_revenue_bridge": "bridge",
    "gross_margin_by_segment": "segment_margin", "customer_cohort_retention": "retention",
}
_DESCRIPTIONS = {
    "fact_sales": "Sales, one row per order line; amounts in USD.",
    "fact_gl": "Ledger postings; revenue negative, expenses positive.",
    "dim_customer": "Customers with segment and region history.",
    "dim_product": "Products with category and price history, newest description.",
    "dim_date": "Calendar and fiscal calendar.",
    "dim_region": "Regions and the Unknown member.",
    "dim_channel": "Sales channels.",
    "monthly_revenue_bridge": "Net revenue composition and month-over-month change.",
    "gross_margin_by_segment": "Margin by fiscal year and segment at sale time.",
    "customer_cohort_retention": "Retention by acquisition month.",
}
SELECTS["profile_row_counts"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, '{_DESCRIPTIONS[n]}' AS description FROM {cte}" for n, cte in _TABLES.items()
)
SELECTS["publish_counts"] = " UNION ALL ".join(
    f"SELECT '{'gold' if n[:4] in ('dim_', 'fact') else 'marts'}.{n}' AS table_name, count(*) AS rows FROM {cte}"
    for n, cte in _TABLES.items()
)
_PROFILED = {
    "customer_sk": ("string", "Key of one version of a customer."),
    "customer_id": ("string", "The customer in the source; UNKNOWN where a sale names none."),
    "customer_segment": ("string", "Segment of the customer while the version held."),
    "signup_date": ("date", "Day the customer signed up."),
    "is_current": ("boolean", "Whether the version still holds."),
}
SELECTS["profile_samples"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{kind}' AS data_type, true AS nullable, '{about}' AS description, "
    f"(SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM dim_customer "
    f"WHERE {c} IS NOT NULL ORDER BY v LIMIT 3) s) AS samples"
    for c, (kind, about) in _PROFILED.items()
)
SELECTS["preview"] = f"""
SELECT order_line_id, {text('order_date')}, quantity, {double('net_revenue')}, is_return
FROM fact_sales ORDER BY order_line_id LIMIT 50"""

# Data quality

_POS_COLUMNS = (
    "order_line_id order_id order_date customer_id product_id region channel quantity unit_price discount_pct gross_revenue "
    "discount_amount net_revenue currency _loaded_at _source_file _batch_id _source_system"
).split()
_CUSTOMER_COLUMNS = "customer_sk customer_id customer_name customer_segment region signup_date valid_from valid_to is_current".split()


def _nulls(table: str, cte: str, columns: list[str]) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count_if({c} IS NULL) AS failures FROM {cte}" for c in columns
    ]


SELECTS["dq_not_null"] = " UNION ALL ".join(
    _nulls("bronze_pos_orders", "bronze_pos", _POS_COLUMNS) + _nulls("dim_customer", "dim_customer", _CUSTOMER_COLUMNS)
)
SELECTS["dq_unique"] = "SELECT order_line_id, count(*) AS n FROM bronze_pos GROUP BY 1 HAVING count(*) > 1"
SELECTS["dq_accepted_values"] = """
SELECT region AS value, count(*) AS n FROM bronze_pos
WHERE region NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') GROUP BY 1"""
SELECTS["dq_relationships"] = """
SELECT customer_id AS value, count(*) AS n FROM silver_orders
WHERE customer_id NOT IN (SELECT customer_id FROM silver_customers) GROUP BY 1"""
SELECTS["dq_unique_combination"] = """
SELECT order_id, product_id, count(*) AS n FROM silver_orders GROUP BY 1, 2 HAVING count(*) > 1"""
SELECTS["dq_expression"] = f"""
SELECT order_line_id, {double('gross_revenue_usd', 'discount_amount_usd', 'net_revenue_usd')}
FROM silver_orders WHERE gross_revenue_usd - discount_amount_usd <> net_revenue_usd"""
SELECTS["dq_freshness"] = """
SELECT table_name, CAST(newest AS VARCHAR) AS max_loaded_at, CAST(age AS DOUBLE) AS age_hours,
       CASE WHEN age > 72 THEN 'error' WHEN age > 36 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT *, (epoch(TIMESTAMP '2002-01-03 00:00:00') - epoch(newest)) / 3600 AS age FROM (
  SELECT 'bronze_pos_orders' AS table_name, max(_loaded_at) AS newest FROM bronze_pos
  UNION ALL SELECT 'silver_customers', max(_loaded_at) FROM silver_customers) t) a"""
SELECTS["dq_rowcount"] = """
SELECT checked, n AS source_distinct_lines, m AS fact_rows FROM (
  SELECT 'whole fact' AS checked, 0.10 AS tolerance, (SELECT count(DISTINCT order_line_id) FROM bronze_pos) AS n,
         (SELECT count(*) FROM fact_sales) AS m
  UNION ALL
  SELECT 'without returns', 0.01, (SELECT count(DISTINCT order_line_id) FROM bronze_pos),
         (SELECT count(*) FROM fact_sales WHERE NOT is_return)) c
WHERE abs(m - n) > tolerance * n"""
SELECTS["dq_gl_tie_out"] = """
SELECT checked, CAST(s AS DOUBLE) AS sales_net_usd, CAST(g AS DOUBLE) AS gl_revenue_usd, CAST(abs(s - g) AS DOUBLE) AS abs_diff
FROM (SELECT 'all sales' AS checked, -1 AS tolerance, (SELECT sum(net_revenue) FROM fact_sales) AS s,
             (SELECT -sum(amount_usd) FROM fact_gl WHERE account_code = '4000') AS g
      UNION ALL
      SELECT 'without returns', 1, (SELECT sum(net_revenue) FROM fact_sales WHERE NOT is_return),
             (SELECT -sum(amount_usd) FROM fact_gl WHERE account_code = '4000')) t
WHERE abs(s - g) > tolerance"""
SELECTS["dq_margin_range"] = """
SELECT 'gross_margin_by_segment' AS model, CAST(fiscal_year AS VARCHAR) AS grp, CAST(gross_margin_pct AS DOUBLE) AS gross_margin_pct
FROM segment_margin WHERE gross_margin_pct NOT BETWEEN 37.2 AND 37.6
UNION ALL
SELECT 'monthly_revenue_bridge', CAST(month_start AS VARCHAR), CAST(gross_margin_pct AS DOUBLE)
FROM bridge WHERE gross_margin_pct NOT BETWEEN 37.2 AND 37.6"""
SELECTS["dq_net_revenue_sign"] = f"""
SELECT order_line_id, {double('net_revenue')} FROM fact_sales WHERE NOT quantity < -25 AND net_revenue < 0"""
SELECTS["dq_orphans"] = """
SELECT f.order_line_id, f.customer_sk, f.product_sk, f.region_sk, f.channel_sk, f.date_key
FROM fact_sales f
LEFT JOIN (SELECT customer_sk FROM dim_customer WHERE customer_segment <> 'BUILDING') c ON f.customer_sk = c.customer_sk
LEFT JOIN (SELECT product_sk FROM dim_product WHERE category <> 'PROMO') p ON f.product_sk = p.product_sk
LEFT JOIN dim_region r ON f.region_sk = r.region_sk
LEFT JOIN dim_channel ch ON f.channel_sk = ch.channel_sk
LEFT JOIN (SELECT date_key FROM dim_date WHERE calendar_year < 2001) d ON f.date_key = d.date_key
WHERE c.customer_sk IS NULL OR p.product_sk IS NULL OR r.region_sk IS NULL OR ch.channel_sk IS NULL OR d.date_key IS NULL"""
CTES["faulty_customers"] = """
SELECT * REPLACE (CASE WHEN region = 'ASIA' THEN DATE '9999-12-31' ELSE valid_to END AS valid_to,
                  is_current AND customer_segment <> 'BUILDING' AS is_current) FROM dim_customer"""
SELECTS["dq_scd2_overlap"] = """
SELECT a.customer_id, CAST(a.valid_from AS VARCHAR) AS valid_from, CAST(a.valid_to AS VARCHAR) AS valid_to,
       CAST(max(b.valid_to) AS VARCHAR) AS earlier_valid_to
FROM faulty_customers a JOIN faulty_customers b
  ON a.customer_id = b.customer_id AND (b.valid_from < a.valid_from OR b.valid_from = a.valid_from AND b.valid_to < a.valid_to)
GROUP BY a.customer_id, a.valid_from, a.valid_to HAVING a.valid_from < max(b.valid_to)"""
SELECTS["dq_scd2_current"] = """
SELECT customer_id AS entity, count_if(is_current) AS current_versions FROM faulty_customers GROUP BY 1 HAVING count_if(is_current) <> 1
UNION ALL
SELECT product_id, count_if(is_current) FROM dim_product GROUP BY 1 HAVING count_if(is_current) <> 1"""
SELECTS["dq_missing_rates"] = """
SELECT CAST(order_month AS VARCHAR) AS order_month, currency, count(*) AS n
FROM silver_orders WHERE currency <> 'USD'
  AND NOT EXISTS (SELECT 1 FROM silver_fx WHERE rate_month = order_month AND from_currency = currency AND to_currency = 'USD')
GROUP BY 1, 2"""

_SUITE_TABLES = {
    "raw_pos_orders": "bronze_pos", "raw_gl_extract": "bronze_gl", "raw_customer_master": "bronze_customers",
    "raw_product_master": "bronze_products",
    "silver_orders": "silver_orders", "silver_customers": "silver_customers", "silver_products": "silver_products",
    "silver_gl": "silver_gl", "silver_fx_rates": "silver_fx", **_TABLES,
}


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _suite() -> str:
    out = []

    def add(table: str, test: str, column: str, counted: str) -> None:
        out.append(f"SELECT '{table}' AS table_name, '{test}' AS test, '{column}' AS column_name, {counted}")

    for table, columns in suite.REQUIRED.items():
        for c in columns:
            add(table, "not_null", c, f"count_if({c} IS NULL) AS failures FROM {_SUITE_TABLES[table]}")
    for table, columns in suite.UNIQUE.items():
        for c in columns:
            add(table, "unique", c, f"count(*) AS failures FROM (SELECT {c} FROM {_SUITE_TABLES[table]} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) u")
    for (table, c), values in suite.ACCEPTED.items():
        allowed = ", ".join(_literal(v) for v in values)
        add(table, "accepted_values", c, f"count(DISTINCT {c}) AS failures FROM {_SUITE_TABLES[table]} WHERE {c} NOT IN ({allowed})")
    for (table, c), parent in suite.PARENTS.items():
        add(table, "relationships", c, f"count(DISTINCT {c}) AS failures FROM {_SUITE_TABLES[table]} WHERE {c} NOT IN (SELECT {c} FROM {_TABLES[parent]})")
    for table, columns in suite.COMBINATION.items():
        keys = ", ".join(columns)
        add(table, "unique_combination", "+".join(columns),
            f"count(*) AS failures FROM (SELECT {keys} FROM {_SUITE_TABLES[table]} GROUP BY ALL HAVING count(*) > 1) u")
    for table, condition in suite.EXPRESSION.items():
        add(table, "expression", condition, f"count(*) AS failures FROM {_SUITE_TABLES[table]} WHERE NOT ({condition})")
    for (table, name), failing in suite.RULES.items():
        add(table, "rule", name, f"count(*) AS failures FROM ({failing}) r")
    return " UNION ALL ".join(out)


SELECTS["dq_suite"] = _suite()

# Audit

SELECTS["audit_scan"] = "SELECT call_time, tool, metric, decision, reason, call_rows, latency_ms FROM audit_calls"
SELECTS["audit_decisions"] = "SELECT decision, count(*) AS calls FROM audit_calls GROUP BY 1"
SELECTS["audit_denials"] = """
SELECT reason, count(*) AS calls FROM audit_calls WHERE decision = 'deny' GROUP BY 1 ORDER BY calls DESC, reason LIMIT 5"""
SELECTS["audit_tools"] = "SELECT tool, count(*) AS calls FROM audit_calls GROUP BY 1"
SELECTS["audit_metrics"] = """
SELECT metric, count(*) AS calls FROM audit_calls WHERE tool = 'query_metric' GROUP BY 1 ORDER BY calls DESC, metric LIMIT 5"""
SELECTS["audit_slowest"] = """
SELECT call_time, tool, decision, latency_ms FROM audit_calls ORDER BY latency_ms DESC, call_time, tool, decision LIMIT 5"""
SELECTS["audit_screen_statements"] = r"""
SELECT event_id, screen_reason = 'fine' AS allowed, screen_reason FROM (
  SELECT event_id, CASE
    WHEN NOT regexp_matches(sql, '\S') THEN 'blank'
    WHEN NOT regexp_matches(code, '\S') THEN 'comments'
    WHEN len(parts) <> 1 THEN 'parts:' || CAST(len(parts) AS VARCHAR)
    WHEN NOT regexp_matches(parts[1], '(?i)^\s*(with|select)\b') THEN 'opening'
    WHEN word <> '' THEN 'word:' || upper(word) ELSE 'fine' END AS screen_reason
  FROM (SELECT *, regexp_extract(parts[1], '(?i)\b(INSERT|UPDATE|DELETE|DROP|ALTER|CREATE|MERGE|COPY|GRANT|REVOKE|ATTACH|DETACH|INSTALL|LOAD|PRAGMA|EXPORT|IMPORT|VACUUM|REINDEX|READ_CSV|READ_CSV_AUTO|READ_PARQUET|READ_JSON|READ_JSON_AUTO|READ_TEXT|READ_BLOB|PARQUET_SCAN|CSV_SCAN|GLOB)\b', 1) AS word
        FROM (SELECT *, list_filter(string_split(code, ';'), lambda x: regexp_matches(x, '\S')) AS parts
              FROM (SELECT *, regexp_replace(regexp_replace(sql, '/\*(.|\n)*?\*/', ' ', 'g'), '--[^\n]*', ' ', 'g') AS code FROM statements) a) b) c) d"""
SELECTS["audit_totals"] = """
SELECT unnest(['all', 'allow', 'deny', 'other', 'without_tool']) AS measure,
       unnest([count(*), count_if(decision = 'allow'), count_if(decision = 'deny'),
               count_if(decision IS NULL OR decision NOT IN ('allow', 'deny')), count_if(tool IS NULL)]) AS calls FROM audit_calls"""
SELECTS["metric_truncated"] = f"""
SELECT *, true AS truncated FROM ({_metric("net_revenue", ["fiscal_year", "fiscal_month", "region"])}) m
ORDER BY fiscal_year, fiscal_month, region LIMIT 40"""

# Production path
SELECTS["store_upsert"] = f"""
SELECT order_line_id, CAST(CASE WHEN again AND quantity % 5 = 0 THEN order_date + 31 ELSE order_date END AS VARCHAR) AS order_date,
       quantity + CASE WHEN again THEN 100 ELSE 0 END AS quantity, {double('net_revenue')}, {text('_loaded_at')}
FROM (SELECT *, _loaded_at >= TIMESTAMP '1999-01-01' AS again FROM fact_sales) f"""
SELECTS["additive_schema"] = f"""
SELECT order_line_id, {text('order_date')}, quantity, CASE WHEN y = 1996 THEN channel END AS channel,
       CASE WHEN y = 1997 THEN region END AS region, CASE WHEN y = 1997 THEN currency END AS currency
FROM (SELECT *, year(order_date) AS y FROM silver_orders) s WHERE y BETWEEN 1995 AND 1997"""
SELECTS["stream_audit_counters"] = "SELECT tool, decision, count(*) AS calls FROM audit_calls GROUP BY ALL"
for _name, _same in {"silver_incremental": "silver_orders", "snapshot_stored": "snapshot_check", "stream_fact_sales": "fact_sales",
                     "stream_landing": "landing_files", "build_increments": "fact_sales"}.items():
    SELECTS[_name] = SELECTS[_same]

for _name, _same in {"fact_sales_salted": "fact_sales", "point_in_time_salted": "point_in_time_join", "dq_orphans_salted": "dq_orphans"}.items():
    SELECTS[_name] = SELECTS[_same]

ORACLES = {name: statement(select) for name, select in SELECTS.items()}
