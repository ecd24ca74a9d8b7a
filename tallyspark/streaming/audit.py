"""Streaming counters over an audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyspark.operators.audit import parse_lines
from tallyspark.sources.store import TableStore

FILES_PER_TRIGGER = 1000
COUNTERS = "gold.audit_counters"


def call_counts(spark: SparkSession, folder: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Running calls per tool and decision; write it in ``update`` mode. State holds
    one counter per pair."""
    calls = parse_lines(spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder))
    return calls.groupBy("tool", "decision").agg(F.count(F.lit(1)).alias("calls"))


def counter_stream(
    spark: SparkSession, store: TableStore, folder: str, checkpoint: str, files_per_trigger: int = FILES_PER_TRIGGER
) -> DataStreamWriter:
    """Writer that keeps the counters as a stored table. A micro-batch brings the new totals of the pairs it touched,
    so one that runs again writes the same totals."""

    def keep(batch: DataFrame, _: int) -> None:
        store.upsert(COUNTERS, batch, ["tool", "decision"], F.lit("counters"))

    counts = call_counts(spark, folder, files_per_trigger)
    return counts.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
