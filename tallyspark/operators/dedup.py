"""Keep one row per key.

Written as ``row_number() = 1`` so Spark limits each key to one row inside every
map task before the shuffle: a key repeated a billion times sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOAD_ORDER = ("_loaded_at", "_batch_id")


def keep_first(df: DataFrame, keys: Sequence[str], newest: bool, order: Sequence[str] = LOAD_ORDER) -> DataFrame:
    """One row per key by load order. Rows loaded together are told apart by their
    remaining columns, ascending, so a rerun picks the same row."""
    direction = F.desc_nulls_last if newest else F.asc_nulls_first
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[direction(c) for c in order], *[F.asc_nulls_first(c) for c in rest])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def earliest(df: DataFrame, *keys: str) -> DataFrame:
    return keep_first(df, keys, newest=False)


def latest(df: DataFrame, *keys: str) -> DataFrame:
    return keep_first(df, keys, newest=True)
