"""Landing: gate files, then append the passing, not yet loaded ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.gate import MALFORMED, verdicts, violations
from tallyspark.operators.joins import lookup_join
from tallyspark.sources.contracts import FeedContract
from tallyspark.sources.feeds import (
    discover, empty_files, header_columns, header_fault, manifest, read_text_columns, stamp, unmatched, waves,
)
from tallyspark.sources.records import numbered_lines, open_files
from tallyspark.sources.store import TableStore


@dataclass(frozen=True)
class Landed:
    """What happened to one file: append, skip or reject, and why it was rejected before its rows were read."""

    feed: str | None
    file: str
    batch_id: str | None
    rows: int | None
    action: str
    reason: str | None = None


@dataclass(frozen=True)
class Run:
    """A landing run over all feeds of a folder. Rejected files and files of no feed fail it."""

    files: list[Landed]

    @property
    def failed(self) -> list[Landed]:
        return [f for f in self.files if f.action == "reject"]

    @property
    def passed(self) -> bool:
        return not self.failed


def land_folder(
    spark: SparkSession,
    store: TableStore,
    folder: str,
    contracts: Sequence[FeedContract],
    loaded_at: dt.datetime,
    dry_run: bool = False,
) -> Run:
    """Land every feed of a folder; files that fit no feed are reported as rejected, too."""
    report = [Landed(None, name, None, None, "reject", "no_feed") for name in unmatched(spark, folder, contracts)]
    for contract in contracts:
        report += land_feed(spark, store, folder, contract, loaded_at, dry_run)
    return Run(report)


def land_feed(
    spark: SparkSession,
    store: TableStore,
    folder: str,
    contract: FeedContract,
    loaded_at: dt.datetime,
    dry_run: bool = False,
) -> list[Landed]:
    """Land a folder's files of one feed, a bounded wave of files at a time.

    Only file names, hashes, headers and verdicts reach the driver; rows go from the
    CSV scan straight to Parquet. A rejected file does not stop the others.
    """
    report = [Landed(contract.feed, name, None, 0, "reject", "no_bytes") for name in empty_files(spark, folder, contract)]
    seen: set[str] = set()
    for wave in waves(discover(spark, folder, contract)):
        report += land_wave(spark, store, wave, contract, loaded_at, dry_run, seen)
    return report


def land_wave(spark, store, wave, contract, loaded_at, dry_run, seen: set[str] | None = None) -> list[Landed]:
    """Land one wave. ``seen`` carries the ids of earlier waves, which a dry run leaves out of the store."""
    seen = set() if seen is None else seen
    table = f"raw.{contract.raw_table}"
    names = {f.path: f.name for f in wave}
    found = manifest(spark, wave).orderBy("path").collect()  # at most WAVE_FILES rows
    known = store.known_batches(table, [f.batch_id for f in found])
    report, layouts = [], {}
    broken = [f.path for f in found if f.broken and f.batch_id not in known]
    unclosed = {r.path for r in open_files(numbered_lines(spark, broken)).collect()} if broken else set()
    rejected: dict[str, str] = {}
    for f in found:
        if f.batch_id in rejected:
            report.append(Landed(contract.feed, names[f.path], f.batch_id, None, "reject", rejected[f.batch_id]))
            continue
        if f.batch_id in known or f.batch_id in seen:
            report.append(Landed(contract.feed, names[f.path], f.batch_id, None, "skip"))
            continue
        seen.add(f.batch_id)
        columns = header_columns(f.header or "")
        fault = header_fault(columns) or ("open_quote" if f.path in unclosed else None)
        if fault:
            rejected[f.batch_id] = fault
            report.append(Landed(contract.feed, names[f.path], f.batch_id, None, "reject", fault))
        else:
            layouts.setdefault(columns, []).append(f)
    for columns, group in layouts.items():
        report += _land_layout(spark, store, table, columns, group, names, contract, loaded_at, dry_run)
    return report


def stamped_rows(spark, columns, group, names, contract: FeedContract, loaded_at) -> DataFrame:
    """Rows of one wave's files with load metadata; the file table joined here has
    at most WAVE_FILES rows."""
    ids = spark.createDataFrame(
        [(f.path, names[f.path], f.batch_id) for f in group], "_file_path string, _name string, _id string"
    )
    kinds = [(k, [f.path for f in group if f.broken == k]) for k in (False, True)]
    read = [read_text_columns(spark, paths, columns, broken) for broken, paths in kinds if paths]
    rows = reduce(DataFrame.unionByName, read)
    joined = rows.join(F.broadcast(ids), F.col("_path") == F.col("_file_path"))
    out = stamp(joined, F.lit(loaded_at), F.col("_name"), F.col("_id"), contract.source_system)
    return out.drop("_path", "_file_path", "_name", "_id")


def _land_layout(spark, store, table, columns, group, names, contract, loaded_at, dry_run) -> list[Landed]:
    rows = stamped_rows(spark, columns, group, names, contract, loaded_at)
    checked = {v.file: v for v in verdicts(rows, contract).collect()}  # one row per file
    report, passing = [], []
    for f in group:
        verdict = checked.get(names[f.path])
        count = 0 if verdict is None else verdict.rows
        fits = set(contract.names) <= set(columns) if verdict is None else verdict.passed
        if fits:
            passing.append(f)
        action = ("would append" if dry_run else "append") if fits else "reject"
        report.append(Landed(contract.feed, names[f.path], f.batch_id, count, action))
    if passing and not dry_run:
        good = stamped_rows(spark, columns, passing, names, contract, loaded_at).drop(MALFORMED)
        store.append(table, good, batches=[f.batch_id for f in passing])
    return report


def gate_report(spark: SparkSession, folder: str, contract: FeedContract) -> list[DataFrame]:
    """Violations of a folder's files, one table per header layout and wave."""
    tables = []
    for wave in waves(discover(spark, folder, contract)):
        names = {f.path: f.name for f in wave}
        layouts: dict[tuple[str, ...], list] = {}
        for f in manifest(spark, wave).collect():  # at most WAVE_FILES rows
            columns = header_columns(f.header or "")
            if not header_fault(columns):
                layouts.setdefault(columns, []).append(f)
        for columns, group in layouts.items():
            rows = stamped_rows(spark, columns, group, names, contract, dt.datetime(1970, 1, 1))
            tables.append(violations(rows, contract))
    return tables


def only_passing(rows: DataFrame, verdict: DataFrame) -> DataFrame:
    """Rows of the files that passed the gate."""
    good = verdict.where("passed").select(F.col("file").alias("_file"))
    return lookup_join(rows, good, "_source_file", "_file", rows.columns, how="left_semi")


def new_batches(rows: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows whose batch is not in ``loaded`` (column ``batch_id``).

    Batches are compared first; the row join then meets a list of batch ids only,
    broadcast when counted small, salted otherwise (one batch may be most rows)."""
    seen = loaded.select(F.col("batch_id").alias("_batch_id")).distinct()
    fresh = rows.select("_batch_id").distinct().join(seen, "_batch_id", "left_anti")
    return lookup_join(rows, fresh.withColumnRenamed("_batch_id", "_fresh"), "_batch_id", "_fresh", rows.columns, how="left_semi")


def landing_plan(rows: DataFrame, loaded: DataFrame, contract: FeedContract) -> DataFrame:
    """Per file and batch: rows, target table and whether it would load."""
    seen = loaded.select(F.col("batch_id").alias("_batch_id"), F.lit(True).alias("_seen")).distinct()
    sized = rows.groupBy("_source_file", "_batch_id").agg(F.count(F.lit(1)).alias("rows"))
    action = F.when(F.col("_seen"), F.lit("skip")).otherwise(F.lit("load"))
    return sized.join(seen, "_batch_id", "left").select(
        F.col("_source_file").alias("file"),
        F.col("_batch_id").alias("batch_id"),
        "rows",
        F.lit(contract.raw_table).alias("target"),
        action.alias("action"),
    )
