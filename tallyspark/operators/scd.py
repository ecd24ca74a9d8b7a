"""Dimension history: change detection, validity windows and check snapshots.

Windows here are partitioned by the dimension key. Their input holds one row per
key and extract date, so a partition is as long as the number of extracts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGINNING_OF_TIME = dt.date(1900, 1, 1)
END_OF_TIME = dt.date(9999, 12, 31)


def version_starts(df: DataFrame, key: str, order: str, tracked: Sequence[str]) -> DataFrame:
    """Rows that open a version: the first per key, or one whose tracked columns
    differ (NULL-safe) from the row before. Adds ``is_first``."""
    w = Window.partitionBy(key).orderBy(order)
    now = F.struct(*tracked)
    flagged = df.withColumns({"is_first": F.row_number().over(w) == 1, "_before": F.lag(now).over(w)})
    return flagged.where(F.col("is_first") | ~now.eqNullSafe(F.col("_before"))).drop("_before")


def validity_windows(starts: DataFrame, key: str, order: str, first_from: Column, open_to: Column) -> DataFrame:
    """Half-open [valid_from, valid_to) per version; drops ``is_first``."""
    w = Window.partitionBy(key).orderBy(order)
    return starts.withColumns(
        {
            "valid_from": F.when(F.col("is_first"), first_from).otherwise(F.col(order)),
            "valid_to": F.coalesce(F.lead(order).over(w), open_to),
        }
    ).drop("is_first")


def state_as_of(df: DataFrame, key: str, order: str, as_of: dt.date) -> DataFrame:
    """Latest row per key dated on or before ``as_of``."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.where(F.col(order) <= F.lit(as_of)).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def check_snapshot(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: str,
    check: Sequence[str],
    captured_at: dt.datetime,
) -> DataFrame:
    """One capture of a check-strategy snapshot.

    New keys open a version at ``captured_at``. A key whose check columns changed
    closes its open version and opens another. Other keys keep the version they
    have, with its unchecked columns as first captured; keys that vanish stay open.
    """
    at = F.lit(captured_at).cast("timestamp")
    fresh = incoming.withColumns({"valid_from": at, "valid_to": F.lit(None).cast("timestamp")})
    if existing is None:
        return fresh
    cols = fresh.columns
    closed = existing.where("valid_to is not null").select(cols)
    held = existing.where("valid_to is null").select(F.struct(*cols).alias("held"))
    new = fresh.select(F.struct(*cols).alias("new"))
    pair = held.join(new, F.col(f"held.{key}") == F.col(f"new.{key}"), "full_outer")
    same = F.struct(*[f"held.{c}" for c in check]).eqNullSafe(F.struct(*[f"new.{c}" for c in check]))
    ended = F.struct(*[(at if c == "valid_to" else F.col(f"held.{c}")).alias(c) for c in cols])
    versions = (
        F.when(F.col("held").isNull(), F.array("new"))
        .when(F.col("new").isNull() | same, F.array("held"))
        .otherwise(F.array(ended, F.col("new")))
    )
    return closed.unionByName(pair.select(F.inline(versions)))


def replay_snapshots(
    history: DataFrame, key: str, order: str, check: Sequence[str], captures: Sequence[dt.date]
) -> DataFrame:
    """Every capture in one pass: what ``check_snapshot`` gives after capturing
    the state as of each date in turn, at that date's midnight."""
    dates = F.array(*[F.lit(d) for d in sorted(captures)])
    due = F.get(F.filter(dates, lambda d: d >= F.col(order)), 0)
    w = Window.partitionBy(key, "_capture").orderBy(F.desc(order))
    seen = (
        history.withColumn("_capture", due)
        .where("_capture is not null")
        .withColumn("_rn", F.row_number().over(w))
        .where("_rn = 1")
        .drop("_rn")
    )
    starts = version_starts(seen, key, "_capture", check)
    windows = validity_windows(starts, key, "_capture", F.col("_capture"), F.lit(None).cast("date"))
    return windows.withColumns(
        {"valid_from": F.col("valid_from").cast("timestamp"), "valid_to": F.col("valid_to").cast("timestamp")}
    ).drop("_capture")


def newest_value(df: DataFrame, key: str, order: str, col: str) -> DataFrame:
    """Newest value of a column per key (SCD1)."""
    return df.groupBy(key).agg(F.max_by(col, order).alias(col))


def overwrite_with_newest(versions: DataFrame, history: DataFrame, key: str, order: str, col: str) -> DataFrame:
    """Show the newest value of ``col`` on every version of its key."""
    newest = newest_value(history, key, order, col)
    return versions.drop(col).join(newest, key, "left")
