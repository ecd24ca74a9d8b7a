"""Reading, writing and shaping shared by the operators of this package."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Releases a statement's shuffle files when the statement ends, so that stages don't add up on disk.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: The folder this package is imported from.
HOME = str(Path(__file__).resolve().parents[2])


#: Rows that a Python worker gets at a time, in place of Spark's default; texts are far longer than usual cells.
BATCH_ROWS = 2_000
DEFAULT_BATCH_ROWS = 10_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


#: Text that a Python worker gets at a time where a chain of operators runs in one application, in place of Spark's
#: default: a batch of very long texts is then as small as one of short texts.
BATCH_BYTES = 4 << 20
DEFAULT_BATCH_BYTES = "67108864b"
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(spark: SparkSession) -> None:
    """`reachable`, with batches bounded by their bytes. A session that sets its own size keeps it."""
    reachable(spark)
    if spark.conf.get(BYTES_SETTING) == DEFAULT_BATCH_BYTES:
        spark.conf.set(BYTES_SETTING, str(BATCH_BYTES))


def reachable(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, too, and get texts in batches that bound
    their memory. A session that sets its own batch size keeps it."""
    if int(spark.conf.get(BATCH_SETTING)) == DEFAULT_BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if HOME not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, [known])])


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a local session without one gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_folder(spark.sparkContext.applicationId)


def settle(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written once to the shared folder: a lost executor costs no more than its open tasks."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only doc_id and text, whatever other columns a table has."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def own_prefix(docs: DataFrame) -> str:
    """A prefix for helper columns that none of a table's column names begins with."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix
