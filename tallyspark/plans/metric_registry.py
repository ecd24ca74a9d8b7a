"""Governed metrics, dimensions and filters.

A request names a metric and how to slice it; the formula lives here. A metric is
declared as partial sums and at most one distinct key, which lets the planner
aggregate the fact before any join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.functions.casting import percent, ratio


@dataclass(frozen=True)
class Dimension:
    """A slice: ``column`` of ``table`` reached by ``key``, or of the fact itself."""

    column: str
    table: str | None = None
    key: str | None = None
    groupable: bool = True
    description: str = ""


@dataclass(frozen=True)
class Filter:
    dimension: Dimension
    kind: str = "string"


@dataclass(frozen=True)
class Metric:
    label: str
    definition: str
    unit: str
    base: str
    value: Callable[[], Column]
    dimensions: tuple[str, ...]
    filters: tuple[str, ...]
    grain: str
    sums: tuple[str, ...] = ()
    distinct: str | None = None
    required: tuple[str, ...] = ()
    base_filter: Callable[[], Column] | None = None
    owner: str = "Finance Data Team"


# Time grains and the fiscal columns each groups by.
TIME_GRAINS = {
    "none": (),
    "fiscal_year": ("fiscal_year",),
    "fiscal_quarter": ("fiscal_year", "fiscal_quarter"),
    "fiscal_month": ("fiscal_year", "fiscal_month"),
}

# The slices a metric may have.
DIMENSIONS = {
    "region": Dimension("region_name", "dim_region", "region_sk", description="Region of the sale or posting."),
    "channel": Dimension("channel_name", "dim_channel", "channel_sk", description="Sales channel."),
    "customer_segment": Dimension(
        "customer_segment", "dim_customer", "customer_sk", description="Segment at the time of sale."
    ),
    "product_category": Dimension("category", "dim_product", "product_sk", description="Product category."),
    "fiscal_year": Dimension("fiscal_year", "dim_date", "date_key", description="Fiscal year."),
    "fiscal_quarter": Dimension("fiscal_quarter", "dim_date", "date_key", description="Fiscal quarter, 1 to 4."),
    "fiscal_month": Dimension("fiscal_month", "dim_date", "date_key", description="Fiscal month, 1 to 12."),
    "cost_center": Dimension("cost_center", description="Ledger cost center."),
    "account_name": Dimension("account_name", description="Ledger account."),
    "customer": Dimension(
        "customer_id", "dim_customer", "customer_sk", groupable=False, description="For distinct-customer counts."
    ),
}

# The filters a metric may have, and how their values are read.
FILTERS = {
    "region": Filter(DIMENSIONS["region"]),
    "channel": Filter(DIMENSIONS["channel"]),
    "customer_segment": Filter(DIMENSIONS["customer_segment"]),
    "product_category": Filter(DIMENSIONS["product_category"]),
    "fiscal_year": Filter(DIMENSIONS["fiscal_year"], "int"),
    "is_return": Filter(Dimension("is_return"), "bool"),
    "currency": Filter(Dimension("currency")),
    "account_code": Filter(Dimension("account_code")),
}

_SALES_DIMENSIONS = (
    "region", "channel", "customer_segment", "product_category", "fiscal_year", "fiscal_quarter", "fiscal_month",
)
_SLICES = ("region", "channel", "customer_segment", "product_category", "fiscal_year")
_OPEX_ACCOUNTS = ("6000", "6100", "6200")

# The governed metrics.
METRICS = {
    "net_revenue": Metric(
        label="Net revenue",
        definition="Net revenue in USD; returns net out.",
        unit="usd",
        base="fact_sales",
        sums=("net_revenue",),
        value=lambda: F.sum("net_revenue"),
        dimensions=_SALES_DIMENSIONS,
        filters=(*_SLICES, "is_return", "currency"),
        grain="fiscal_quarter",
    ),
    "gross_margin_pct": Metric(
        label="Gross margin %",
        definition="Gross profit as a percentage of net revenue.",
        unit="pct",
        base="fact_sales",
        sums=("gross_profit", "net_revenue"),
        value=lambda: percent(F.sum("gross_profit"), F.sum("net_revenue")),
        dimensions=_SALES_DIMENSIONS,
        filters=(*_SLICES, "currency"),
        grain="fiscal_quarter",
    ),
    "average_order_value": Metric(
        label="Average order value",
        definition="Net revenue per distinct order.",
        unit="usd",
        base="fact_sales",
        sums=("net_revenue",),
        distinct="order_id",
        value=lambda: ratio(F.sum("net_revenue"), F.count_distinct("order_id")),
        dimensions=_SALES_DIMENSIONS,
        filters=(*_SLICES, "is_return", "currency"),
        grain="fiscal_quarter",
    ),
    "customer_count": Metric(
        label="Customer count",
        definition="Distinct customers by natural key.",
        unit="count",
        base="fact_sales",
        required=("customer",),
        value=lambda: F.count_distinct("customer_id"),
        dimensions=_SALES_DIMENSIONS,
        filters=_SLICES,
        grain="fiscal_year",
    ),
    "revenue_per_customer": Metric(
        label="Revenue per customer",
        definition="Net revenue per distinct customer.",
        unit="usd",
        base="fact_sales",
        sums=("net_revenue",),
        required=("customer",),
        value=lambda: ratio(F.sum("net_revenue"), F.count_distinct("customer_id")),
        dimensions=_SALES_DIMENSIONS,
        filters=_SLICES,
        grain="fiscal_year",
    ),
    "gl_expense_total": Metric(
        label="Operating expense",
        definition="Operating expense posted to the ledger, in USD.",
        unit="usd",
        base="fact_gl",
        sums=("amount_usd",),
        value=lambda: F.sum("amount_usd"),
        base_filter=lambda: F.col("account_code").isin(*_OPEX_ACCOUNTS),
        dimensions=("region", "cost_center", "account_name", "fiscal_year", "fiscal_quarter", "fiscal_month"),
        filters=("region", "fiscal_year", "account_code"),
        grain="fiscal_quarter",
    ),
}

GOVERNED_BASES = ("fact_sales", "fact_gl", "monthly_revenue_bridge", "gross_margin_by_segment", "customer_cohort_retention")


def check_registry(metrics: dict[str, Metric]) -> None:
    """Reject a registry that names anything undeclared."""
    for name, m in metrics.items():
        if m.base not in GOVERNED_BASES:
            raise ValueError(f"metric {name!r}: base {m.base!r} is not a gold or mart table")
        if m.grain not in TIME_GRAINS:
            raise ValueError(f"metric {name!r}: bad grain {m.grain!r}")
        stray = (set(m.dimensions) | set(m.required)) - set(DIMENSIONS) | set(m.filters) - set(FILTERS)
        if stray:
            raise ValueError(f"metric {name!r}: undeclared {sorted(stray)}")


check_registry(METRICS)
