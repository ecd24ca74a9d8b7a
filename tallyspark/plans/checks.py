"""Declared assertions per table, business rules across tables, and runners that count their failures."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.keys import UNKNOWN_MEMBER
from tallyspark.operators import quality
from tallyspark.sources.contracts import ACCOUNTS, CATEGORIES, CHANNELS, CURRENCIES, REGIONS, SEGMENTS


@dataclass(frozen=True)
class TableChecks:
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: Mapping[str, tuple] = field(default_factory=dict)
    parents: Mapping[str, str] = field(default_factory=dict)
    combination: tuple[str, ...] = ()
    expression: str | None = None


_REGIONS = (*REGIONS, UNKNOWN_MEMBER)
_SEGMENTS = (*SEGMENTS, UNKNOWN_MEMBER)

# Which columns carry which assertion.
CHECKS = {
    "raw_pos_orders": TableChecks(
        required=(
            "order_line_id", "order_id", "order_date", "product_id", "channel", "quantity", "currency",
        ),
        accepted={"channel": CHANNELS, "currency": CURRENCIES},
    ),
    "raw_gl_extract": TableChecks(
        required=("gl_id", "posting_date", "account_code"), unique=("gl_id",), accepted={"account_code": ACCOUNTS}
    ),
    "raw_customer_master": TableChecks(
        required=("customer_segment", "region"), accepted={"customer_segment": SEGMENTS, "region": REGIONS}
    ),
    "raw_product_master": TableChecks(required=("category",), accepted={"category": CATEGORIES}),
    "silver_orders": TableChecks(
        required=(
            "order_line_id", "order_id", "order_date", "order_month", "customer_id", "is_unknown_customer",
            "product_id", "region", "channel", "quantity", "is_return", "currency", "unit_price",
            "discount_pct", "gross_revenue", "discount_amount", "net_revenue", "fx_rate_to_usd",
            "gross_revenue_usd", "discount_amount_usd", "net_revenue_usd",
        ),
        unique=("order_line_id",),
        accepted={"region": _REGIONS, "channel": CHANNELS, "currency": CURRENCIES},
    ),
    "silver_customers": TableChecks(
        required=(
            "customer_id", "extract_date", "customer_name", "customer_segment", "region", "signup_date",
        ),
        accepted={"customer_segment": SEGMENTS, "region": REGIONS},
        combination=("customer_id", "extract_date"),
    ),
    "silver_products": TableChecks(
        required=(
            "product_id", "extract_date", "description", "category", "subcategory", "list_price",
            "standard_cost",
        ),
        accepted={"category": CATEGORIES},
        combination=("product_id", "extract_date"),
    ),
    "silver_gl": TableChecks(
        required=(
            "gl_id", "posting_date", "posting_month", "account_code", "account_name", "region", "cost_center",
            "amount_usd", "currency",
        ),
        unique=("gl_id",),
        accepted={"account_code": ACCOUNTS, "region": REGIONS},
    ),
    "silver_fx_rates": TableChecks(
        required=("rate_month", "from_currency", "to_currency", "rate"),
        combination=("rate_month", "from_currency", "to_currency"),
    ),
    "dim_date": TableChecks(
        required=(
            "date_key", "date_day", "calendar_year", "calendar_quarter", "calendar_month", "fiscal_year",
            "fiscal_year_label", "fiscal_month", "fiscal_quarter",
        ),
        unique=("date_key", "date_day"),
        accepted={"fiscal_month": tuple(range(1, 13)), "fiscal_quarter": (1, 2, 3, 4)},
    ),
    "dim_region": TableChecks(
        required=("region_sk", "region_name"), unique=("region_sk", "region_name"), accepted={"region_name": _REGIONS}
    ),
    "dim_channel": TableChecks(
        required=("channel_sk", "channel_name"),
        unique=("channel_sk", "channel_name"),
        accepted={"channel_name": CHANNELS},
    ),
    "dim_customer": TableChecks(
        required=(
            "customer_sk", "customer_id", "customer_name", "customer_segment", "region", "valid_from",
            "valid_to", "is_current",
        ),
        unique=("customer_sk",),
        accepted={"customer_segment": _SEGMENTS, "region": _REGIONS},
    ),
    "dim_product": TableChecks(
        required=(
            "product_sk", "product_id", "description", "category", "subcategory", "list_price",
            "standard_cost", "valid_from", "valid_to", "is_current",
        ),
        unique=("product_sk",),
    ),
    "fact_sales": TableChecks(
        required=(
            "order_line_id", "order_id", "date_key", "order_date", "customer_sk", "product_sk", "region_sk",
            "channel_sk", "is_return", "is_unknown_customer", "currency", "fx_rate_to_usd", "quantity",
            "gross_revenue", "discount_amount", "net_revenue", "cogs", "gross_profit",
        ),
        unique=("order_line_id",),
        parents={
            "date_key": "dim_date",
            "customer_sk": "dim_customer",
            "product_sk": "dim_product",
            "region_sk": "dim_region",
            "channel_sk": "dim_channel",
        },
    ),
    "fact_gl": TableChecks(
        required=(
            "gl_id", "date_key", "posting_date", "posting_month", "region_sk", "account_code", "account_name",
            "cost_center", "amount_usd",
        ),
        unique=("gl_id",),
        parents={"date_key": "dim_date", "region_sk": "dim_region"},
    ),
    "monthly_revenue_bridge": TableChecks(
        required=(
            "month_start", "fiscal_year", "fiscal_month", "gross_sales", "discounts", "sales_net", "returns",
            "net_revenue", "cogs", "gross_profit", "order_lines",
        ),
        unique=("month_start",),
        expression="round(sales_net + returns, 2) = round(net_revenue, 2)",
    ),
    "gross_margin_by_segment": TableChecks(
        required=(
            "fiscal_year", "customer_segment", "order_lines", "active_customers", "net_revenue", "cogs",
            "gross_profit",
        ),
        combination=("fiscal_year", "customer_segment"),
    ),
    "customer_cohort_retention": TableChecks(
        required=(
            "cohort_month", "cohort_size", "period_number", "active_customers", "retention_pct",
        ),
        combination=("cohort_month", "period_number"),
    ),
}


def _conditions(df: DataFrame, spec: TableChecks) -> DataFrame:
    """Failures of the checks that look at one row at a time: one aggregate over the table."""
    counts = [("not_null", c, F.count_if(F.col(c).isNull())) for c in spec.required]
    if spec.expression is not None:
        counts.append(("expression", spec.expression, F.count_if(~F.expr(spec.expression))))
    one = df.agg(*[n.alias(f"c{i}") for i, (_, _, n) in enumerate(counts)])
    rows = [_entry(test, name, F.col(f"c{i}")) for i, (test, name, _) in enumerate(counts)]
    return one.select(F.inline(F.array(*rows)))


def _entry(test: str, column: str, value: Column, name: str = "failures") -> Column:
    return F.struct(F.lit(test).alias("test"), F.lit(column).alias("column_name"), value.alias(name))


def _per_value(df: DataFrame, spec: TableChecks, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failures of the checks on values and keys: one scan counts the rows of each value of each checked column.

    Values collapse within the map tasks, so a value that most rows hold costs no more than another; parents are held
    against distinct values, never against rows.
    """
    parents = {c: t for c, t in spec.parents.items() if t in tables}
    text = {c: F.col(c).cast("string") for c in (*spec.unique, *spec.accepted, *parents)}
    cells = [F.when(F.col(c).isNotNull(), _entry("unique", c, text[c], "value")) for c in spec.unique]
    cells += [F.when(~F.col(c).isin(*allowed), _entry("accepted_values", c, text[c], "value")) for c, allowed in spec.accepted.items()]
    cells += [F.when(F.col(c).isNotNull(), _entry("relationships", c, text[c], "value")) for c in parents]
    declared = [("unique", c) for c in spec.unique] + [("accepted_values", c) for c in spec.accepted]
    declared += [("relationships", c) for c in parents]
    if spec.combination:
        name = "+".join(spec.combination)
        cells.append(_entry("unique_combination", name, F.to_json(F.struct(*spec.combination)), "value"))
        declared.append(("unique_combination", name))
    counted = df.select(F.explode(F.array_compact(F.array(*cells))).alias("e")).select("e.*")
    counted = counted.groupBy("test", "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    failing = counted.where(~F.col("test").isin("unique", "unique_combination") | (F.col("n") > 1))
    if parents:
        keys = [tables[t].select(_entry("relationships", c, F.col(c).cast("string"), "value").alias("k")).select("k.*") for c, t in parents.items()]
        failing = failing.join(reduce(DataFrame.unionByName, keys).distinct(), ["test", "column_name", "value"], "left_anti")
    found = failing.groupBy("test", "column_name").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1).select(F.inline(F.array(*[_entry(t, c, F.lit(0).cast("bigint")) for t, c in declared])))
    return every.join(F.broadcast(found), ["test", "column_name"], "left").select(
        "test", "column_name", F.coalesce("n", "failures").alias("failures")
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Mapping[str, TableChecks] = CHECKS) -> DataFrame:
    """(table_name, test, column_name, failures) of every declared assertion whose table is given.

    Two scans of a table serve all its checks: one for conditions on a row, one for values and keys.
    """
    out = []
    for name, spec in checks.items():
        df = tables.get(name)
        if df is None:
            continue
        if spec.required or spec.expression is not None:
            out.append(_conditions(df, spec).select(F.lit(name).alias("table_name"), "*"))
        if spec.unique or spec.accepted or spec.combination or any(t in tables for t in spec.parents.values()):
            out.append(_per_value(df, spec, tables).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, out)


#: Tables that the business rules read, and the history tables by the key whose versions they hold.
RULE_TABLES = (
    "raw_pos_orders", "fact_sales", "fact_gl", "dim_date", "dim_customer", "dim_product", "dim_region", "dim_channel",
    "gross_margin_by_segment", "monthly_revenue_bridge",
)
HISTORIES = {"dim_customer": "customer_id", "dim_product": "product_id"}


def business_rules(tables: Mapping[str, DataFrame]) -> list[tuple[str, str, DataFrame]]:
    """Table, name and failing rows of the rules that no single column declares; needs all of RULE_TABLES."""
    missing = [t for t in RULE_TABLES if t not in tables]
    if missing:
        raise ValueError(f"business rules need tables {missing}")
    sales, ledger = tables["fact_sales"], tables["fact_gl"]
    rules = [
        ("fact_sales", "rowcount_within_source", quality.rowcount_within(tables["raw_pos_orders"], sales)),
        ("fact_sales", "net_revenue_sign", quality.negative_sales(sales)),
        ("fact_gl", "ties_to_sales", quality.gl_ties_to_sales(sales, ledger)),
        ("fact_sales", "no_orphan_keys", quality.orphan_keys(sales, {c: tables[t] for c, t in CHECKS["fact_sales"].parents.items()})),
    ]
    margins = quality.margin_in_range(tables["gross_margin_by_segment"], tables["monthly_revenue_bridge"])
    for mart in ("gross_margin_by_segment", "monthly_revenue_bridge"):
        rules.append((mart, "margin_in_range", margins.where(F.col("model") == mart)))
    for history, key in HISTORIES.items():
        rules.append((history, "no_overlapping_windows", quality.overlapping_windows(tables[history], key)))
        rules.append((history, "one_current_version", quality.not_one_current({key: tables[history]})))
    return rules


def run_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, test, column_name, failures) of the business rules; the rule's name stands in place of a column."""
    counted = [
        failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(table).alias("table_name"), F.lit("rule").alias("test"), F.lit(name).alias("column_name"), "failures"
        )
        for table, name, failing in business_rules(tables)
    ]
    return reduce(DataFrame.unionByName, counted)
