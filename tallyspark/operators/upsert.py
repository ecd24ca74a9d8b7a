"""Incremental load: watermark filter and keyed upsert."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_WATERMARK = dt.datetime(1900, 1, 1)


def read_watermark(table: DataFrame | None, col: str = "_loaded_at") -> dt.datetime:
    """Newest load time in a table: a one-row aggregate, so the filter below gets
    a literal that reaches the Parquet scan."""
    if table is None:
        return NO_WATERMARK
    return table.agg(F.max(col)).first()[0] or NO_WATERMARK


def newer_than(df: DataFrame, watermark: dt.datetime, col: str = "_loaded_at") -> DataFrame:
    """Rows loaded strictly after the watermark; a late batch stamped exactly at
    the watermark is taken as already loaded."""
    return df.where(F.col(col) > F.lit(watermark))


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``existing`` with the same key; NULL keys are equal. Columns only one side has
    are appended and filled with NULL. Both sides hold a key once, so neither has a hot key."""
    arriving = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    return existing.join(arriving, same, "left_anti").unionByName(new, allowMissingColumns=True)
