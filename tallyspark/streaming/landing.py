"""Streaming landing: new files in a drop folder pass the gate as they arrive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyspark.sources.contracts import FeedContract
from tallyspark.sources.feeds import WAVE_FILES
from tallyspark.sources.landing import Landed, land_wave
from tallyspark.sources.store import TableStore

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def landing_stream(
    spark: SparkSession,
    store: TableStore,
    folder: str,
    contract: FeedContract,
    checkpoint: str,
    clock: Callable[[], dt.datetime],
    on_landed: Callable[[list[Landed]], None] = lambda report: None,
) -> DataStreamWriter:
    """Writer that lands each micro-batch of files; start it with a trigger such as
    ``trigger(availableNow=True)``. A replayed batch lands nothing twice, since
    content hashes decide."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", contract.file_glob)
        .option("maxFilesPerTrigger", WAVE_FILES)
        .load(folder)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_name").alias("name"),
            F.col("length"),
        )
    )

    def land(batch: DataFrame, _: int) -> None:
        wave = batch.orderBy("path").collect()  # at most WAVE_FILES file names
        if wave:
            on_landed(land_wave(batch.sparkSession, store, wave, contract, clock(), dry_run=False))

    return files.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
