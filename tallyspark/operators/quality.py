"""Data-quality assertions: each returns what fails, so an empty result passes.

Key-based checks aggregate to one row per key before they join or rank, so repeated
keys collapse inside the map tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import BROADCAST_ROWS, rows_within, salted_join

WARN_HOURS = 36
ERROR_HOURS = 72
ROWCOUNT_TOLERANCE = 0.10
TIE_OUT_TOLERANCE = 1.00
REVENUE_ACCOUNT = "4000"
MARGIN_BAND = (-100, 100)


# Generic assertions


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failures) for columns that must hold no null; one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns]
    return counts.select(F.inline(F.array(*entries)))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def repeated_keys(df: DataFrame, keys: Sequence[str], skip_nulls: bool = False) -> DataFrame:
    """Keys held by more than one row, with the count."""
    rows = df.dropna(subset=list(keys)) if skip_nulls else df
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    return repeated_keys(df, [column], skip_nulls=True)


def unique_combination(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return repeated_keys(df, keys)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their row counts."""
    bad = df.where(~F.col(column).isin(*values))
    return bad.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values with no parent, with their row counts."""
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(F.col(parent_column).alias("value")).distinct(), "value", "left_anti")


def expression_true(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~condition)


def freshness(
    df: DataFrame, now: dt.datetime, warn_hours: int = WARN_HOURS, error_hours: int = ERROR_HOURS, col: str = "_loaded_at"
) -> DataFrame:
    """Newest load time, its age in hours at ``now``, and pass / warn / error."""
    newest = df.agg(F.max(col).cast("timestamp").alias("max_loaded_at"))
    age = (F.unix_timestamp(F.lit(now)) - F.unix_timestamp("max_loaded_at")) / 3600
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), F.lit("error"))
        .when(F.col("age_hours") > warn_hours, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return newest.withColumn("age_hours", age).withColumn("status", status)


# Business rules


def _one_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row aggregates side by side."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def rowcount_within(source: DataFrame, fact: DataFrame, key: str = "order_line_id", tolerance: float = ROWCOUNT_TOLERANCE) -> DataFrame:
    """Fails when fact rows stray from the distinct source keys by over 10 %."""
    both = _one_row(
        source.agg(F.count_distinct(key).alias("source_distinct_lines")),
        fact.agg(F.count(F.lit(1)).alias("fact_rows")),
    )
    gap = F.abs(F.col("fact_rows") - F.col("source_distinct_lines"))
    return both.where(gap > F.lit(tolerance) * F.col("source_distinct_lines"))


def tie_out(sales: DataFrame, ledger: DataFrame) -> DataFrame:
    """Sales net revenue, ledger revenue (sign turned) and their gap; one row."""
    both = _one_row(
        sales.agg(F.sum("net_revenue").alias("sales_net_usd")),
        ledger.where(F.col("account_code") == REVENUE_ACCOUNT).agg((-F.sum("amount_usd")).alias("gl_revenue_usd")),
    )
    return both.withColumn("abs_diff", F.abs(F.col("sales_net_usd") - F.col("gl_revenue_usd")))


def gl_ties_to_sales(sales: DataFrame, ledger: DataFrame, tolerance: float = TIE_OUT_TOLERANCE) -> DataFrame:
    return tie_out(sales, ledger).where(F.col("abs_diff") > tolerance)


def margin_in_range(by_segment: DataFrame, bridge: DataFrame, low: float = MARGIN_BAND[0], high: float = MARGIN_BAND[1]) -> DataFrame:
    """Margins outside [low, high] in either mart."""

    def outside(df: DataFrame, model: str, group: str) -> DataFrame:
        return df.where(~F.col("gross_margin_pct").between(low, high)).select(
            F.lit(model).alias("model"), F.col(group).cast("string").alias("grp"), "gross_margin_pct"
        )

    return outside(by_segment, "gross_margin_by_segment", "fiscal_year").unionByName(
        outside(bridge, "monthly_revenue_bridge", "month_start")
    )


def negative_sales(fact: DataFrame) -> DataFrame:
    """Lines that are no return but net below zero."""
    return fact.where(~F.col("is_return") & (F.col("net_revenue") < 0)).select("order_line_id", "net_revenue")


def _lost_keys(fact: DataFrame, dimensions: Mapping[str, DataFrame], limit: int) -> DataFrame | None:
    """(_place, _lost): key values of the fact, as text, that their dimension lacks; None if there are over ``limit``.

    Key values collapse within the map tasks before they meet the dimensions, so no row of the fact is shuffled."""
    cells = [F.struct(F.lit(i).alias("_place"), F.col(key).cast("string").alias("_lost")) for i, key in enumerate(dimensions)]
    seen = fact.select(F.explode(F.array(*cells)).alias("c")).select("c.*").where("_lost IS NOT NULL").distinct()
    held = [
        dim.select(F.lit(i).alias("_place"), F.col(key).cast(fact.schema[key].dataType).cast("string").alias("_lost"))
        for i, (key, dim) in enumerate(dimensions.items())
    ]
    found = seen.join(reduce(DataFrame.unionByName, held), ["_place", "_lost"], "left_anti").limit(limit + 1).collect()
    return fact.sparkSession.createDataFrame(found, "_place int, _lost string") if len(found) <= limit else None


def orphan_keys(
    fact: DataFrame, dimensions: Mapping[str, DataFrame], max_broadcast_rows: int = BROADCAST_ROWS, max_lost_keys: int = BROADCAST_ROWS
) -> DataFrame:
    """Fact rows with any foreign key missing from its dimension (or null).

    ``dimensions`` maps a fact key column to the dimension with a column of that name. Dimensions of at most
    ``max_broadcast_rows`` rows are broadcast. For the others one more scan finds the key values without a member; up to
    ``max_lost_keys`` of them are broadcast in the dimensions' place, and beyond that rows and dimensions are shuffled."""
    rows = fact.select("order_line_id", *dimensions)
    held = {key: dim.select(F.col(key).alias("_dim_key")).distinct() for key, dim in dimensions.items()}
    large = [key for key in dimensions if not rows_within(held[key], max_broadcast_rows)]
    lost = _lost_keys(fact, {key: dimensions[key] for key in large}, max_lost_keys) if large else None
    for key in dimensions:
        if lost is not None and key in large:
            own = F.broadcast(lost.where(F.col("_place") == large.index(key)).select("_lost"))
            rows = rows.join(own, F.col(key).cast("string") == F.col("_lost"), "left")
            rows = rows.withColumn(f"_no_{key}", F.col(key).isNull() | F.col("_lost").isNotNull()).drop("_lost")
            continue
        if key in large:
            rows = salted_join(rows, held[key], key, "_dim_key", ["order_line_id"], base=fact)
        else:
            rows = rows.join(F.broadcast(held[key]), F.col(key) == F.col("_dim_key"), "left")
        rows = rows.withColumn(f"_no_{key}", F.col("_dim_key").isNull()).drop("_dim_key")
    orphan = reduce(lambda a, b: a | b, [F.col(f"_no_{k}") for k in dimensions])
    return rows.where(orphan).select("order_line_id", *dimensions)


def overlapping_windows(dim: DataFrame, key: str) -> DataFrame:
    """Versions that start before an earlier version of the key has ended.

    Linear in the versions: each is compared with the latest end seen before it
    instead of with every other version."""
    before = Window.partitionBy(key).orderBy("valid_from", "valid_to").rowsBetween(Window.unboundedPreceding, -1)
    return (
        dim.select(key, "valid_from", "valid_to")
        .withColumn("earlier_valid_to", F.max("valid_to").over(before))
        .where(F.col("valid_from") < F.col("earlier_valid_to"))
    )


def not_one_current(dims: Mapping[str, DataFrame]) -> DataFrame:
    """Entities without exactly one current version, none included.

    ``dims`` maps a key column to its dimension."""

    def bad(key: str, dim: DataFrame) -> DataFrame:
        counts = dim.groupBy(F.col(key).alias("entity")).agg(F.count_if("is_current").alias("current_versions"))
        return counts.where("current_versions <> 1")

    return reduce(DataFrame.unionByName, [bad(k, d) for k, d in dims.items()])


def missing_rates(orders: DataFrame, fx: DataFrame, reporting: str = "USD") -> DataFrame:
    """Lines in other currencies that fell back to rate 1 because no rate exists;
    an added check, since the fallback itself is silent."""
    foreign = orders.where(F.col("currency") != reporting)
    lines = foreign.groupBy("order_month", "currency").agg(F.count(F.lit(1)).alias("n"))
    known = fx.where(F.col("to_currency") == reporting).select(
        F.col("rate_month").alias("order_month"), F.col("from_currency").alias("currency")
    )
    return lines.join(known.distinct(), ["order_month", "currency"], "left_anti")
