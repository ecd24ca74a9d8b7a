"""Finance marts.

Each mart aggregates the fact by its own key columns (map-side combined) before it
joins a dimension that grows with the business, so a customer that holds a third of
all lines arrives at the join as a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.calendar import month_start, months_between_firsts
from tallyspark.functions.casting import percent
from tallyspark.operators.joins import lookup_join


def revenue_composition(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Per month: gross sales, discounts, sales, returns, net, cost and profit."""
    sale = ~F.col("is_return")
    zero = F.lit(0).cast("decimal(18,2)")

    def total(col: str, when=None):
        return F.sum(F.col(col) if when is None else F.when(when, F.col(col)).otherwise(zero))

    daily = fact.groupBy("date_key", month_start(F.col("order_date")).alias("month_start")).agg(
        total("gross_revenue", sale).alias("gross_sales"),
        total("discount_amount", sale).alias("discounts"),
        total("net_revenue", sale).alias("sales_net"),
        total("net_revenue", F.col("is_return")).alias("returns"),
        total("net_revenue").alias("net_revenue"),
        total("cogs").alias("cogs"),
        total("gross_profit").alias("gross_profit"),
        F.count(F.lit(1)).alias("order_lines"),
    )
    labels = dates.select("date_key", "fiscal_year", "fiscal_month", "fiscal_year_label")
    measures = ("gross_sales", "discounts", "sales_net", "returns", "net_revenue", "cogs", "gross_profit")
    return (
        daily.join(labels, "date_key")
        .groupBy("month_start", "fiscal_year", "fiscal_month", "fiscal_year_label")
        .agg(
            *[F.sum(m).alias(m) for m in measures],
            F.sum("order_lines").alias("order_lines"),
        )
    )


def revenue_period(monthly: DataFrame) -> DataFrame:
    """Month-over-month bridge. The window has no partition: its input holds one
    row per month. "Prior" is the previous month present."""
    prior = F.lag("net_revenue").over(Window.orderBy("month_start"))
    return monthly.withColumn("prior_net_revenue", prior).withColumns(
        {
            "mom_change": F.col("net_revenue") - F.col("prior_net_revenue"),
            "mom_change_pct": percent(F.col("net_revenue") - F.col("prior_net_revenue"), F.col("prior_net_revenue")),
            "gross_margin_pct": percent(F.col("gross_profit"), F.col("net_revenue")),
        }
    )


def monthly_revenue_bridge(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return revenue_period(revenue_composition(fact, dates)).select(
        "month_start", "fiscal_year", "fiscal_year_label", "fiscal_month",
        "gross_sales", "discounts", "sales_net", "returns", "net_revenue",
        "prior_net_revenue", "mom_change", "mom_change_pct",
        "cogs", "gross_profit", "gross_margin_pct", "order_lines",
    )


def gross_margin_by_segment(fact: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Margin per fiscal year and the segment the customer was in at sale time."""
    measures = ("net_revenue", "cogs", "gross_profit")
    years = dates.select(F.col("date_key").alias("_day"), "fiscal_year", "fiscal_year_label")
    per_version = (
        lookup_join(fact, years, "date_key", "_day", ["order_line_id"], how="inner")
        .groupBy("customer_sk", "fiscal_year", "fiscal_year_label")
        .agg(F.count(F.lit(1)).alias("order_lines"), *[F.sum(m).alias(m) for m in measures])
    )
    segments = customers.select(F.col("customer_sk").alias("_sk"), "customer_id", "customer_segment")
    return (
        lookup_join(per_version, segments, "customer_sk", "_sk", ["customer_sk", "fiscal_year"], how="inner")
        .groupBy("fiscal_year", "fiscal_year_label", "customer_segment")
        .agg(
            F.sum("order_lines").alias("order_lines"),
            F.count_distinct("customer_id").alias("active_customers"),
            *[F.sum(m).alias(m) for m in measures],
        )
        .withColumn("gross_margin_pct", percent(F.col("gross_profit"), F.col("net_revenue")))
        .select(
            "fiscal_year", "fiscal_year_label", "customer_segment", "order_lines", "active_customers",
            "net_revenue", "cogs", "gross_profit", "gross_margin_pct",
        )
    )


def purchase_months(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct (customer_id, order_month); unknown customers and returns left out."""
    sales = fact.where(~F.col("is_unknown_customer") & ~F.col("is_return"))
    bought = sales.select("customer_sk", month_start(F.col("order_date")).alias("order_month")).distinct()
    names = customers.select(F.col("customer_sk").alias("_sk"), "customer_id")
    # Hot keys are looked for in the stored sales, which need no second shuffle for it.
    return (
        lookup_join(bought, names, "customer_sk", "_sk", ["customer_sk", "order_month"], how="inner", base=sales)
        .select("customer_id", "order_month")
        .distinct()
    )


def first_purchase(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("customer_id").agg(F.min("order_month").alias("cohort_month"))


def cohort_periods(purchases: DataFrame) -> DataFrame:
    """Per customer and active month: the cohort and months since it. A customer has
    at most one row per month here, so the window stays short."""
    cohort = F.min("order_month").over(Window.partitionBy("customer_id"))
    return purchases.withColumn("cohort_month", cohort).select(
        "customer_id",
        "cohort_month",
        months_between_firsts(F.col("order_month"), F.col("cohort_month")).alias("period_number"),
    )


def customer_cohort_retention(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Retention triangle. Every cohort member is active in period 0, so its active
    count there is the cohort size."""
    active = (
        cohort_periods(purchase_months(fact, customers))
        .groupBy("cohort_month", "period_number")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    in_first = F.when(F.col("period_number") == 0, F.col("active_customers"))
    size = F.max(in_first).over(Window.partitionBy("cohort_month"))
    return active.withColumn("cohort_size", size).select(
        "cohort_month",
        "cohort_size",
        "period_number",
        "active_customers",
        percent(F.col("active_customers"), F.col("cohort_size")).alias("retention_pct"),
    )
