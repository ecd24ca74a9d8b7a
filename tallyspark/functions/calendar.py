"""Calendar and fiscal-calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FISCAL_START_MONTH = 2
SPINE_START = dt.date(2021, 2, 1)
SPINE_END = dt.date(2026, 2, 1)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def months_between_firsts(later: Column, earlier: Column) -> Column:
    """Whole calendar months from one month start to another."""
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("bigint")


def fiscal_year(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    return F.year(F.add_months(day, 1 - start_month)).cast("bigint")


def fiscal_month(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    return F.month(F.add_months(day, 1 - start_month)).cast("bigint")


def fiscal_quarter(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    return F.quarter(F.add_months(day, 1 - start_month)).cast("bigint")


def fiscal_label(year: Column) -> Column:
    return F.concat(F.lit("FY"), year.cast("string"))


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in [start, end)."""
    last = end - dt.timedelta(days=1)
    days = F.sequence(F.lit(start), F.lit(last))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def spine_over(df: DataFrame, day: str) -> DataFrame:
    """Spine covering every day a table spans (one-row aggregate, then exploded)."""
    bounds = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).where("lo is not null")
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("date_day"))
