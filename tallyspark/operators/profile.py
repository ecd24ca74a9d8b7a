"""Table listing, column profile and preview."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PREVIEW_MAX = 50
SAMPLES_PER_COLUMN = 3

TABLE_DESCRIPTIONS = {
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

#: What a column of the governed tables holds; a name means the same in each of them.
COLUMN_DESCRIPTIONS = {
    "date_key": "Day as the number YYYYMMDD.",
    "date_day": "The day itself.",
    "calendar_year": "Year of the day.",
    "calendar_quarter": "Quarter of the year, 1 to 4.",
    "calendar_month": "Month of the year, 1 to 12.",
    "month_name": "English name of the month.",
    "day_of_month": "Day within its month.",
    "day_name": "English name of the weekday.",
    "is_weekend": "Whether the day is a Saturday or Sunday.",
    "fiscal_year": "Year in which the fiscal year starts; it runs from February to January.",
    "fiscal_year_label": "Fiscal year written as FY and the year.",
    "fiscal_month": "Month of the fiscal year; February is 1.",
    "fiscal_quarter": "Quarter of the fiscal year; February to April is 1.",
    "region_sk": "Key of the region, hashed from its name.",
    "region_name": "Canonical region, or Unknown.",
    "channel_sk": "Key of the channel, hashed from its name.",
    "channel_name": "Sales channel.",
    "customer_sk": "Key of one version of a customer.",
    "customer_id": "The customer in the source; UNKNOWN where a sale names none.",
    "customer_name": "Name of the customer.",
    "customer_segment": "Segment of the customer while the version held.",
    "region": "Region of the customer while the version held.",
    "signup_date": "Day the customer signed up.",
    "product_sk": "Key of one version of a product.",
    "product_id": "The product in the source.",
    "description": "Newest description of the product, on all its versions.",
    "category": "Category while the version held.",
    "subcategory": "Subcategory while the version held.",
    "list_price": "List price while the version held.",
    "standard_cost": "Cost of a unit while the version held.",
    "valid_from": "First day or moment of the version.",
    "valid_to": "First day or moment after the version; 9999-12-31 while it holds.",
    "is_current": "Whether the version still holds.",
    "order_line_id": "The order line; one row of the sales fact each.",
    "order_id": "The order that the line belongs to.",
    "order_date": "Day of the order.",
    "is_return": "Whether the line is a return, by its negative quantity.",
    "is_unknown_customer": "Whether the source named no customer.",
    "currency": "Currency of the line before conversion.",
    "fx_rate_to_usd": "The month's rate into USD; 1 where none is known.",
    "quantity": "Units; negative for returns.",
    "gross_revenue": "USD before discount.",
    "discount_amount": "Discount in USD.",
    "net_revenue": "USD after discount; returns count as negative.",
    "cogs": "Quantity times the current version's standard cost.",
    "gross_profit": "Net revenue less cost.",
    "gl_id": "The ledger posting.",
    "posting_date": "Day of the posting.",
    "posting_month": "First day of the posting's month.",
    "account_code": "Ledger account.",
    "account_name": "Name of the ledger account.",
    "cost_center": "Cost center of the posting.",
    "amount_usd": "Amount in USD; revenue is negative, expense positive.",
    "_loaded_at": "When the row's file was landed.",
    "month_start": "First day of the month.",
    "gross_sales": "USD before discount of lines that are no returns.",
    "discounts": "Discounts of lines that are no returns.",
    "sales_net": "Net revenue of lines that are no returns.",
    "returns": "Net revenue of returns; zero or less.",
    "prior_net_revenue": "Net revenue of the month before in the table.",
    "mom_change": "Net revenue less that of the month before.",
    "mom_change_pct": "That change in percent of the month before.",
    "gross_margin_pct": "Gross profit in percent of net revenue.",
    "order_lines": "Number of order lines.",
    "active_customers": "Distinct customers who bought.",
    "cohort_month": "First day of the month of a customer's first purchase.",
    "cohort_size": "Customers whose first purchase lies in the month.",
    "period_number": "Months since the cohort's first.",
    "retention_pct": "Active customers in percent of the cohort.",
}


def table_listing(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, description) of the governed tables."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(TABLE_DESCRIPTIONS.get(name, "")).alias("description")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def column_profile(df: DataFrame, descriptions: Mapping[str, str] = COLUMN_DESCRIPTIONS) -> DataFrame:
    """(column_name, data_type, nullable, description, samples): each column's three first distinct values in text
    order, of the whole table. A column that ``descriptions`` doesn't name has an empty one.

    One scan feeds all columns. Values are made distinct and cut to three per column within the map tasks, so the
    shuffle carries a few values per task whatever the table holds.
    """
    fields = df.schema.fields
    cells = [F.struct(F.lit(i).alias("i"), F.col(f"`{f.name}`").cast("string").alias("v")) for i, f in enumerate(fields)]
    seen = df.select(F.explode(F.array(*cells)).alias("c")).select("c.i", "c.v").where("v IS NOT NULL").distinct()
    place = F.row_number().over(Window.partitionBy("i").orderBy("v"))
    first = seen.withColumn("place", place).where(F.col("place") <= SAMPLES_PER_COLUMN)
    samples = first.groupBy("i").agg(F.array_sort(F.collect_list("v")).alias("samples"))
    about = F.array(
        *[
            F.struct(
                F.lit(i).alias("column"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
                F.lit(descriptions.get(f.name, "")).alias("description"),
            )
            for i, f in enumerate(fields)
        ]
    )
    listed = df.sparkSession.range(1).select(F.inline(about))
    none = F.array().cast("array<string>")
    return listed.join(samples, F.col("column") == F.col("i"), "left").select(
        "column_name", "data_type", "nullable", "description", F.coalesce("samples", none).alias("samples")
    )


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First n rows by ``order``; n is clamped to 1..50."""
    return df.orderBy(*order).limit(max(1, min(int(n), PREVIEW_MAX)))
