"""DuckDB SQL that derives every warehouse table and query result independently.

``CTES`` holds one named step each; ``statement`` puts the steps a query needs, in
order, in front of it.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}

CTES["buyer_region"] = """
SELECT c.*, r_name FROM customer c JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

CTES["raw_pos"] = """
SELECT f.*,
       CAST(CAST(quantity AS DECIMAL(18,0)) * unit_price AS DECIMAL(18,2)) AS gross_revenue,
       CAST(round(CAST(CAST(quantity AS DECIMAL(18,0)) * unit_price AS DECIMAL(18,2)) * discount_pct, 2) AS DECIMAL(18,2)) AS discount_amount
FROM (
  SELECT 'OL-' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') || '-' || CAST(l_linenumber AS VARCHAR) AS order_line_id,
         'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS order_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN l_orderkey % 331 = 0 THEN NULL WHEN l_orderkey % 337 = 0 THEN '  '
              ELSE 'CUST-' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') END AS customer_id,
         'PROD-' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS product_id,
         CASE l_partkey % 12 WHEN 0 THEN lower(r_name) WHEN 1 THEN r_name || ' ' WHEN 2 THEN ' ' || r_name
              WHEN 3 THEN substr(r_name, 1, 2) || '.'
              WHEN 4 THEN CASE WHEN year(o_orderdate) % 2 = 0 THEN 'N/A' ELSE 'Elsewhere' END
              ELSE r_name END AS region,
         CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'Online'
              WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'Wholesale' ELSE 'Retail' END AS channel,
         CAST(CASE WHEN l_returnflag = 'R' AND l_suppkey % 10 = 0 THEN -l_quantity ELSE l_quantity END AS BIGINT) AS quantity,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
         CAST(l_discount AS DECIMAL(4,2)) AS discount_pct,
         CASE WHEN l_suppkey % 7 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
         make_timestamp(year(o_orderdate) + 1, 1, 1, 0, 0, 0) AS _loaded_at,
         'pos_' || CAST(year(o_orderdate) AS VARCHAR) AS _source_file,
         substr(md5(CAST(year(o_orderdate) AS VARCHAR)), 1, 16) AS _batch_id,
         'POS' AS _source_system
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN buyer_region ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
) f"""

CTES["bronze_pos"] = """
SELECT order_line_id, order_id, order_date, customer_id, product_id, region, channel, quantity,
       CAST(unit_price AS DECIMAL(18,4)) AS unit_price, CAST(CAST(discount_pct AS VARCHAR) AS DOUBLE) AS discount_pct,
       CAST(gross_revenue AS DECIMAL(18,4)) AS gross_revenue, CAST(discount_amount AS DECIMAL(18,4)) AS discount_amount,
       CAST(gross_revenue - discount_amount AS DECIMAL(18,4)) AS net_revenue,
       currency, _loaded_at, _source_file, _batch_id, _source_system
FROM raw_pos"""

CTES["extracts"] = """
SELECT unnest([DATE '1995-01-01', DATE '1997-01-01', DATE '1999-01-01']) AS extract_date"""

CTES["bronze_customers_once"] = """
SELECT extract_date, 'CUST-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS customer_id,
       '  ' || c_name || ' ' AS customer_name,
       CASE WHEN c_custkey % 5 = 0 AND extract_date >= DATE '1997-01-01' THEN
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'BUILDING' WHEN 'BUILDING' THEN 'FURNITURE' WHEN 'FURNITURE' THEN 'HOUSEHOLD'
              WHEN 'HOUSEHOLD' THEN 'MACHINERY' WHEN 'MACHINERY' THEN 'AUTOMOBILE' END ELSE c_mktsegment END AS customer_segment,
       CASE WHEN c_custkey % 7 = 0 AND extract_date >= DATE '1999-01-01' THEN
         CASE r_name WHEN 'AFRICA' THEN 'AMERICA' WHEN 'AMERICA' THEN 'ASIA' WHEN 'ASIA' THEN 'EUROPE'
              WHEN 'EUROPE' THEN 'MIDDLE EAST' WHEN 'MIDDLE EAST' THEN 'AFRICA' END ELSE r_name END AS region,
       DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS signup_date,
       CAST(extract_date + 1 AS TIMESTAMP) AS _loaded_at,
       'customer_master_' || CAST(extract_date AS VARCHAR) || '.csv' AS _source_file,
       substr(md5('customer_master_' || CAST(extract_date AS VARCHAR)), 1, 16) AS _batch_id,
       'CRM-Master' AS _source_system, c_custkey
FROM buyer_region, extracts"""

CTES["bronze_customers"] = """
SELECT * EXCLUDE (c_custkey) FROM bronze_customers_once
UNION ALL
SELECT extract_date, customer_id, trim(customer_name) || ' II', customer_segment, region, signup_date,
       CAST(extract_date + 2 AS TIMESTAMP), 'customer_master_reload.csv', substr(md5('customer_master_reload'), 1, 16), _source_system
FROM bronze_customers_once WHERE extract_date = DATE '1997-01-01' AND c_custkey % 11 = 0"""

CTES["bronze_products_once"] = """
SELECT extract_date, 'PROD-' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS product_id,
       CASE WHEN p_partkey % 100 = 1 AND extract_date >= DATE '1999-01-01' THEN p_name || ' (rev)' ELSE p_name END AS description,
       CASE WHEN p_partkey % 50 = 0 AND extract_date >= DATE '1997-01-01' THEN 'PROMO' ELSE p_type END AS category,
       p_brand AS subcategory,
       CAST(CASE WHEN p_partkey % 40 = 0 AND extract_date >= DATE '1999-01-01'
            THEN round(CAST(p_retailprice AS DECIMAL(16,2)) * CAST(1.08 AS DECIMAL(3,2)), 2)
            ELSE CAST(p_retailprice AS DECIMAL(16,2)) END AS DECIMAL(18,4)) AS list_price,
       CAST(round(CAST(p_retailprice AS DECIMAL(16,2)) * CAST(0.60 AS DECIMAL(3,2)), 2) AS DECIMAL(18,4)) AS standard_cost,
       CAST(extract_date + 1 AS TIMESTAMP) AS _loaded_at,
       'product_master_' || CAST(extract_date AS VARCHAR) || '.csv' AS _source_file,
       substr(md5('product_master_' || CAST(extract_date AS VARCHAR)), 1, 16) AS _batch_id,
       'PIM-Master' AS _source_system, p_partkey
FROM part, extracts"""

CTES["bronze_products"] = """
SELECT * EXCLUDE (p_partkey) FROM bronze_products_once
UNION ALL
SELECT extract_date, product_id, trim(description) || ' II', category, subcategory, list_price, standard_cost,
       CAST(extract_date + 2 AS TIMESTAMP), 'product_master_reload.csv', substr(md5('product_master_reload'), 1, 16), _source_system
FROM bronze_products_once WHERE extract_date = DATE '1997-01-01' AND p_partkey % 13 = 0"""

CTES["order_months"] = """
SELECT DISTINCT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS rate_date FROM orders"""

CTES["bronze_fx"] = """
SELECT rate_date, from_currency, to_currency, CAST(rate AS DECIMAL(18,9)) AS rate,
       TIMESTAMP '2002-01-01 00:00:00' AS _loaded_at, 'fx_rates.csv' AS _source_file,
       substr(md5('fx_rates'), 1, 16) AS _batch_id, 'Treasury-FX' AS _source_system
FROM (
  SELECT rate_date, 'EUR' AS from_currency, 'USD' AS to_currency,
         CAST(CAST(105 + month(rate_date) AS DECIMAL(18,6)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,6)) AS rate
  FROM order_months WHERE rate_date <> DATE '1996-02-01'
  UNION ALL SELECT rate_date, 'USD', 'USD', CAST(1 AS DECIMAL(18,6)) FROM order_months
  UNION ALL SELECT rate_date, 'EUR', 'GBP', CAST(0.85 AS DECIMAL(18,6)) FROM order_months
) r"""

CTES["silver_fx"] = """
SELECT CAST(date_trunc('month', rate_date) AS DATE) AS rate_month, from_currency, to_currency, rate FROM bronze_fx"""

CTES["region_map"] = """
SELECT r_name AS raw_region, r_name AS region_canonical FROM region
UNION ALL SELECT lower(r_name), r_name FROM region
UNION ALL SELECT substr(r_name, 1, 2) || '.', r_name FROM region"""

CTES["orders_deduped"] = """
SELECT * FROM bronze_pos
QUALIFY row_number() OVER (PARTITION BY order_line_id ORDER BY _loaded_at, _batch_id, order_id, order_date,
  customer_id NULLS FIRST, product_id, region, channel, quantity, unit_price, discount_pct, gross_revenue,
  discount_amount, net_revenue, currency, _source_file, _source_system) = 1"""

CTES["silver_orders"] = """
SELECT o.order_line_id, o.order_id, o.order_date, CAST(date_trunc('month', o.order_date) AS DATE) AS order_month,
       coalesce(nullif(trim(o.customer_id), ''), 'UNKNOWN') AS customer_id,
       (o.customer_id IS NULL OR trim(o.customer_id) = '') AS is_unknown_customer,
       o.product_id, coalesce(m.region_canonical, 'Unknown') AS region, o.region AS region_raw, o.channel, o.quantity,
       (o.quantity < 0) AS is_return, o.currency, o.unit_price, o.discount_pct, o.gross_revenue, o.discount_amount, o.net_revenue,
       coalesce(x.rate, 1) AS fx_rate_to_usd,
       CAST(round(o.gross_revenue * coalesce(x.rate, CAST(1 AS DECIMAL(18,9))), 2) AS DECIMAL(18,2)) AS gross_revenue_usd,
       CAST(round(o.discount_amount * coalesce(x.rate, CAST(1 AS DECIMAL(18,9))), 2) AS DECIMAL(18,2)) AS discount_amount_usd,
       CAST(round(o.net_revenue * coalesce(x.rate, CAST(1 AS DECIMAL(18,9))), 2) AS DECIMAL(18,2)) AS net_revenue_usd,
       o._loaded_at, o._source_file, o._batch_id
FROM orders_deduped o
LEFT JOIN region_map m ON trim(o.region) = m.raw_region
LEFT JOIN silver_fx x ON x.rate_month = CAST(date_trunc('month', o.order_date) AS DATE)
  AND x.from_currency = o.currency AND x.to_currency = 'USD'"""

CTES["silver_customers"] = """
SELECT customer_id, extract_date, trim(customer_name) AS customer_name, customer_segment, region, signup_date,
       _loaded_at, _source_file, _batch_id
FROM bronze_customers
QUALIFY row_number() OVER (PARTITION BY customer_id, extract_date ORDER BY _loaded_at DESC, _batch_id DESC) = 1"""

CTES["silver_products"] = """
SELECT product_id, extract_date, trim(description) AS description, category, subcategory, list_price, standard_cost,
       _loaded_at, _source_file, _batch_id
FROM bronze_products
QUALIFY row_number() OVER (PARTITION BY product_id, extract_date ORDER BY _loaded_at DESC, _batch_id DESC) = 1"""

CTES["gl_sums"] = """
SELECT order_month, region, channel, sum(net) AS net, sum(round(units * standard_cost, 2)) AS cogs
FROM (SELECT order_month, region, channel, product_id, sum(net_revenue_usd) AS net, sum(quantity) AS units
      FROM silver_orders GROUP BY ALL) p
JOIN (SELECT product_id, arg_max(standard_cost, extract_date) AS standard_cost FROM silver_products GROUP BY 1) c USING (product_id)
GROUP BY ALL"""

CTES["gl_posted"] = """
SELECT order_month, region, '4000' AS account_code, 'Product Revenue' AS account_name, channel AS cost_center, -net AS amount FROM gl_sums
UNION ALL SELECT order_month, region, '5000', 'Cost of Goods Sold', channel, cogs FROM gl_sums
UNION ALL
SELECT order_month, region, code, label, 'Corporate', round(CAST(net AS DECIMAL(30,2)) * pct, 2)
FROM (SELECT order_month, region, sum(net) AS net FROM gl_sums GROUP BY ALL) r,
     (VALUES ('6000', 'Selling Expense', CAST(0.18 AS DECIMAL(3,2))), ('6100', 'Marketing Expense', CAST(0.06 AS DECIMAL(3,2))),
             ('6200', 'General Expense', CAST(0.04 AS DECIMAL(3,2)))) a(code, label, pct)"""

CTES["bronze_gl"] = """
SELECT 'GL-' || substr(md5(CAST(order_month AS VARCHAR) || '|' || region || '|' || account_code || '|' || cost_center), 1, 16) AS gl_id,
       order_month + 27 AS posting_date, account_code, account_name, region, cost_center,
       CAST(amount AS DECIMAL(18,4)) AS amount_usd, 'USD' AS currency, 'ERP' AS source_system,
       TIMESTAMP '2002-01-01 00:00:00' AS _loaded_at, 'gl_extract.csv' AS _source_file,
       substr(md5('gl_extract'), 1, 16) AS _batch_id, 'ERP-GL' AS _source_system
FROM gl_posted"""

CTES["silver_gl"] = """
SELECT gl_id, posting_date, CAST(date_trunc('month', posting_date) AS DATE) AS posting_month, account_code, account_name,
       region, cost_center, amount_usd, currency, source_system, _loaded_at, _source_file, _batch_id
FROM bronze_gl"""

CTES["customer_starts"] = """
SELECT * FROM (
  SELECT customer_id, extract_date, customer_name, customer_segment, region, signup_date,
         row_number() OVER w = 1 AS is_first,
         lag(customer_segment) OVER w AS before_segment, lag(region) OVER w AS before_region
  FROM silver_customers WINDOW w AS (PARTITION BY customer_id ORDER BY extract_date)) f
WHERE is_first OR customer_segment IS DISTINCT FROM before_segment OR region IS DISTINCT FROM before_region"""

CTES["customer_windows"] = """
SELECT customer_id, customer_name, customer_segment, region, signup_date,
       CASE WHEN is_first THEN DATE '1900-01-01' ELSE extract_date END AS valid_from,
       coalesce(lead(extract_date) OVER (PARTITION BY customer_id ORDER BY extract_date), DATE '9999-12-31') AS valid_to
FROM customer_starts"""

CTES["dim_customer"] = """
SELECT md5(customer_id || '-' || CAST(valid_from AS VARCHAR)) AS customer_sk, customer_id, customer_name, customer_segment,
       region, signup_date, valid_from, valid_to, valid_to = DATE '9999-12-31' AS is_current
FROM (SELECT * FROM customer_windows
      UNION ALL SELECT 'UNKNOWN', 'Unknown Customer', 'Unknown', 'Unknown', NULL, DATE '1900-01-01', DATE '9999-12-31') u"""

CTES["product_snapshot"] = """
SELECT product_id, description, category, subcategory, list_price, standard_cost, extract_date,
       CAST(extract_date AS TIMESTAMP) AS valid_from,
       CAST(lead(extract_date) OVER (PARTITION BY product_id ORDER BY extract_date) AS TIMESTAMP) AS valid_to
FROM (SELECT *, row_number() OVER w AS rn, lag(category) OVER w AS before_category, lag(list_price) OVER w AS before_price
      FROM silver_products WINDOW w AS (PARTITION BY product_id ORDER BY extract_date)) f
WHERE rn = 1 OR category IS DISTINCT FROM before_category OR list_price IS DISTINCT FROM before_price"""

CTES["newest_description"] = """
SELECT product_id, arg_max(description, extract_date) AS description FROM silver_products GROUP BY 1"""

CTES["dim_product"] = """
SELECT md5(s.product_id || '-' || CAST(s.valid_from AS VARCHAR)) AS product_sk, s.product_id, n.description, s.category,
       s.subcategory, s.list_price, s.standard_cost, s.valid_from,
       coalesce(s.valid_to, TIMESTAMP '9999-12-31 00:00:00') AS valid_to, s.valid_to IS NULL AS is_current
FROM product_snapshot s LEFT JOIN newest_description n ON s.product_id = n.product_id"""

CTES["calendar"] = """
SELECT CAST(d AS DATE) AS date_day FROM generate_series(TIMESTAMP '1994-02-01', TIMESTAMP '2003-01-31', INTERVAL 1 DAY) g(d)"""

CTES["data_calendar"] = """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day
FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders) b"""


def _calendar_columns(source: str) -> str:
    return f"""
SELECT year(date_day) * 10000 + month(date_day) * 100 + day(date_day) AS date_key, date_day,
       year(date_day) AS calendar_year, quarter(date_day) AS calendar_quarter, month(date_day) AS calendar_month,
       monthname(date_day) AS month_name, day(date_day) AS day_of_month, dayname(date_day) AS day_name,
       dayofweek(date_day) IN (0, 6) AS is_weekend,
       CASE WHEN month(date_day) >= 2 THEN year(date_day) ELSE year(date_day) - 1 END AS fiscal_year,
       'FY' || CAST(CASE WHEN month(date_day) >= 2 THEN year(date_day) ELSE year(date_day) - 1 END AS VARCHAR) AS fiscal_year_label,
       (month(date_day) + 10) % 12 + 1 AS fiscal_month,
       CAST(((month(date_day) + 10) % 12) // 3 + 1 AS BIGINT) AS fiscal_quarter
FROM {source}"""


CTES["dim_date"] = _calendar_columns("calendar")
CTES["data_dim_date"] = _calendar_columns("data_calendar")

CTES["dim_region"] = """
SELECT md5(region_name) AS region_sk, region_name
FROM (SELECT DISTINCT region_canonical AS region_name FROM region_map UNION SELECT 'Unknown') u"""

CTES["dim_channel"] = """
SELECT md5(channel_name) AS channel_sk, channel_name FROM (SELECT DISTINCT channel AS channel_name FROM silver_orders) c"""

CTES["fact_sales"] = """
SELECT o.order_line_id, o.order_id,
       year(o.order_date) * 10000 + month(o.order_date) * 100 + day(o.order_date) AS date_key, o.order_date,
       dc.customer_sk, dp.product_sk, dr.region_sk, dch.channel_sk, o.is_return, o.is_unknown_customer, o.currency,
       o.fx_rate_to_usd, o.quantity, o.gross_revenue_usd AS gross_revenue, o.discount_amount_usd AS discount_amount,
       o.net_revenue_usd AS net_revenue,
       CAST(round(o.quantity * dp.standard_cost, 2) AS DECIMAL(18,2)) AS cogs,
       CAST(round(o.net_revenue_usd - o.quantity * dp.standard_cost, 2) AS DECIMAL(18,2)) AS gross_profit, o._loaded_at
FROM silver_orders o
LEFT JOIN dim_customer dc ON o.customer_id = dc.customer_id AND o.order_date >= dc.valid_from AND o.order_date < dc.valid_to
LEFT JOIN (SELECT product_id, product_sk, standard_cost FROM dim_product WHERE is_current) dp ON o.product_id = dp.product_id
LEFT JOIN dim_region dr ON o.region = dr.region_name
LEFT JOIN dim_channel dch ON o.channel = dch.channel_name"""

CTES["fact_gl"] = """
SELECT g.gl_id, year(g.posting_date) * 10000 + month(g.posting_date) * 100 + day(g.posting_date) AS date_key,
       g.posting_date, g.posting_month, dr.region_sk, g.account_code, g.account_name, g.cost_center, g.amount_usd
FROM silver_gl g LEFT JOIN dim_region dr ON g.region = dr.region_name"""

CTES["composition"] = """
SELECT CAST(date_trunc('month', f.order_date) AS DATE) AS month_start, d.fiscal_year, d.fiscal_month,
       min(d.fiscal_year_label) AS fiscal_year_label,
       sum(CASE WHEN NOT is_return THEN gross_revenue ELSE 0 END) AS gross_sales,
       sum(CASE WHEN NOT is_return THEN discount_amount ELSE 0 END) AS discounts,
       sum(CASE WHEN NOT is_return THEN net_revenue ELSE 0 END) AS sales_net,
       sum(CASE WHEN is_return THEN net_revenue ELSE 0 END) AS returns,
       sum(net_revenue) AS net_revenue, sum(cogs) AS cogs, sum(gross_profit) AS gross_profit, count(*) AS order_lines
FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2, 3"""

CTES["bridge"] = """
SELECT *, lag(net_revenue) OVER m AS prior_net_revenue, net_revenue - lag(net_revenue) OVER m AS mom_change,
       round(CAST(100 * (net_revenue - lag(net_revenue) OVER m) / nullif(lag(net_revenue) OVER m, 0) AS DECIMAL(38,6)), 2) AS mom_change_pct,
       round(CAST(100 * gross_profit / nullif(net_revenue, 0) AS DECIMAL(38,6)), 2) AS gross_margin_pct
FROM composition WINDOW m AS (ORDER BY month_start)"""

CTES["segment_margin"] = """
SELECT d.fiscal_year, min(d.fiscal_year_label) AS fiscal_year_label, c.customer_segment, count(*) AS order_lines,
       count(DISTINCT c.customer_id) AS active_customers, sum(f.net_revenue) AS net_revenue, sum(f.cogs) AS cogs,
       sum(f.gross_profit) AS gross_profit,
       round(CAST(100 * sum(f.gross_profit) / nullif(sum(f.net_revenue), 0) AS DECIMAL(38,6)), 2) AS gross_margin_pct
FROM fact_sales f JOIN dim_customer c ON f.customer_sk = c.customer_sk JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.fiscal_year, c.customer_segment"""

CTES["purchases"] = """
SELECT c.customer_id, CAST(date_trunc('month', f.order_date) AS DATE) AS order_month
FROM fact_sales f JOIN dim_customer c ON f.customer_sk = c.customer_sk
WHERE NOT f.is_unknown_customer AND NOT f.is_return"""

CTES["first_purchase"] = """
SELECT customer_id, min(order_month) AS cohort_month FROM purchases GROUP BY customer_id"""

CTES["periods"] = """
SELECT customer_id, cohort_month,
       (year(order_month) - year(cohort_month)) * 12 + month(order_month) - month(cohort_month) AS period_number
FROM (SELECT DISTINCT p.customer_id, f.cohort_month, p.order_month
      FROM purchases p JOIN first_purchase f ON p.customer_id = f.customer_id) a"""

CTES["retention"] = """
SELECT a.cohort_month, s.cohort_size, a.period_number, a.active_customers,
       round(CAST(100 * a.active_customers / nullif(s.cohort_size, 0) AS DECIMAL(38,6)), 2) AS retention_pct
FROM (SELECT cohort_month, period_number, count(DISTINCT customer_id) AS active_customers FROM periods GROUP BY 1, 2) a
JOIN (SELECT cohort_month, count(DISTINCT customer_id) AS cohort_size FROM first_purchase GROUP BY 1) s
  ON a.cohort_month = s.cohort_month"""

CTES["audit_calls"] = """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS call_time,
       CASE event_type WHEN 'click' THEN 'query_metric' WHEN 'view' THEN 'preview' WHEN 'purchase' THEN 'run_query'
            WHEN 'signup' THEN 'list_tables' ELSE 'query_metric' END AS tool,
       ['net_revenue', 'gross_margin_pct', 'average_order_value', 'customer_count', 'revenue_per_customer', 'gl_expense_total'][k % 6 + 1] AS metric,
       CASE WHEN event_type = 'error' THEN 'deny' ELSE 'allow' END AS decision,
       CASE WHEN event_type = 'error' THEN 'reason ' || CAST(k % 7 AS VARCHAR) ELSE 'ok' END AS reason,
       CASE WHEN event_type <> 'error' THEN k END AS call_rows, value AS latency_ms
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
WHERE event_id % 89 <> 0 AND event_id % 97 <> 0"""

CTES["statements"] = r"""
SELECT event_id, replace([
  'SELECT channel_sk, count(*) AS n FROM gold.fact_sales WHERE date_key > @ GROUP BY channel_sk',
  'WITH big AS (SELECT * FROM gold.fact_gl WHERE amount_usd > @) SELECT account_code, count(*) FROM big GROUP BY 1',
  'SELECT @ AS a; SELECT 2 AS b',
  'SELECT @ /* first; */ ; -- second' || chr(10) || ' SELECT 3 AS c;',
  '/* @ */ TRUNCATE gold.dim_region',
  'DESCRIBE gold.dim_date -- @',
  'WITH old AS (SELECT @ AS k) MERGE INTO gold.dim_product USING old ON true',
  'SELECT max(x) FROM (VALUES (@)) AS t(x) WHERE ''revoke'' <> ''grant''',
  'VACUUM gold.fact_sales -- @',
  'SELECT n FROM read_parquet(''part-@.parquet'')',
  'SELECT line FROM Read_Text(''log-@'')',
  chr(10) || chr(10) || chr(9) || 'With t AS (SELECT @ AS i) Select i FROM t;',
  '-- @ was here' || chr(10) || '/* and left */',
  chr(9) || chr(10) || ' ',
  'SELECT ''we load at @'' AS note',
  'SELECT uploaded_@, recreated FROM gold.fact_gl',
  'SELECT d.*, ''/* @ */'' AS stars FROM gold.dim_date d',
  'SELECT @ -- one' || chr(10) || 'FROM gold.dim_channel /* two' || chr(10) || 'three */ LIMIT 4',
  ';;; ;',
  'CREATE VIEW v@ AS SELECT 1',
  'SELECT @ AS a -- /* one' || chr(10) || '; SELECT 2 AS b */'
][event_id % 21 + 1], '@', CAST(event_id AS VARCHAR)) AS sql FROM events"""


def steps_for(text: str) -> list[str]:
    """Steps a text names, each after the ones it needs itself."""
    order: list[str] = []

    def visit(body: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", body):
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(text)
    return order


def statement(select: str) -> str:
    steps = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in steps_for(select))
    return f"WITH {steps}\n{select}" if steps else select
