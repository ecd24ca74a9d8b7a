"""Null-safe casts from landed text to contract types, and exact money arithmetic.

Money stays DECIMAL end to end. Numbers land with nine decimals and are priced with them: DECIMAL(28,9) amounts times
DECIMAL(18,9) rates are DECIMAL(38,9), rounded to cents after. From silver on amounts are DECIMAL(18,4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CENTS = "decimal(18,2)"
NUMERIC_SCALE = 9
RATE_SCALE = 9
#: Amounts from silver on.
AMOUNT = "decimal(18,4)"

# Text date layouts the gate accepts besides ISO.
DATE_LAYOUTS = ("MM/dd/yyyy", "dd-MMM-yyyy", "yyyy/MM/dd", "yyyyMMdd", "MMM d, yyyy")

TRUE_WORDS = ("true", "True", "1")
FALSE_WORDS = ("false", "False", "0")


def spark_type(logical: str, scale: int | None = None) -> str:
    """Physical Spark type of a contract type."""
    if logical == "numeric":
        return f"decimal(28,{NUMERIC_SCALE})" if scale is None else f"decimal(18,{scale})"
    return {
        "string": "string",
        "integer": "bigint",
        "float": "double",
        "date": "date",
        "timestamp": "timestamp",
        "boolean": "boolean",
    }[logical]


def null_safe_cast(col: Column, logical: str, scale: int | None = None) -> Column:
    """Cast text, giving NULL instead of an error. '3.0' is an integer here, as it
    is for the gate, so integers go through a decimal first."""
    if logical == "integer":
        return F.round(col.try_cast("decimal(38,9)"), 0).try_cast("bigint")
    if logical == "boolean":
        return F.when(col.isin(*TRUE_WORDS), F.lit(True)).when(col.isin(*FALSE_WORDS), F.lit(False))
    return col.try_cast(spark_type(logical, scale))


def parse_timestamp(col: Column) -> Column:
    """Timestamp from ISO text or one of DATE_LAYOUTS; NULL when none fits."""
    iso = F.when(col.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), col.try_cast("timestamp"))
    return F.coalesce(iso, *[F.try_to_timestamp(col, F.lit(layout)) for layout in DATE_LAYOUTS])


def narrowed(df: DataFrame, *amounts: str) -> DataFrame:
    """Landed amounts rounded to silver's four decimals, half away from zero; NULL where one has over 14 digits before
    the point, which the gate lets no file land."""
    return df.withColumns({a: F.round(a, 4).try_cast(AMOUNT) for a in amounts})


def cents(amount: Column) -> Column:
    """Round half away from zero to cents."""
    return F.round(amount, 2).cast(CENTS)


def ratio(numerator: Column, denominator: Column, places: int = 2, factor: int = 1) -> Column:
    """round(factor * numerator / denominator, places); NULL on a zero denominator."""
    quotient = F.lit(factor) * numerator / F.nullif(denominator, F.lit(0))
    return F.round(quotient.cast("decimal(38,6)"), places)


def percent(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator, factor=100)
