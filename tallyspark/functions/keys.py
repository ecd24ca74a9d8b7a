"""Key expressions shared by dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_CUSTOMER = "UNKNOWN"
UNKNOWN_MEMBER = "Unknown"

# The public surrogate-key convention (separator and NULL word).
KEY_SEPARATOR = "-"
KEY_NULL_WORD = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column) -> Column:
    """md5 over the key columns as text; NULL parts hash as a fixed word."""
    parts = [F.coalesce(c.cast("string"), F.lit(KEY_NULL_WORD)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def member_key(natural: Column) -> Column:
    """Surrogate key of a dimension whose only attribute is its natural key.

    The key is a pure function of the natural key, so a fact built from the same
    conformed column needs no join to find it. NULL stays NULL, as a left join
    on the natural key would leave it.
    """
    return F.when(natural.isNotNull(), surrogate_key(natural))


def date_key(day: Column) -> Column:
    """Integer key yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def resolved_customer(customer_id: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(customer_id), F.lit("")), F.lit(UNKNOWN_CUSTOMER))


def is_missing_text(col: Column) -> Column:
    return F.coalesce(F.trim(col) == "", F.lit(True))
