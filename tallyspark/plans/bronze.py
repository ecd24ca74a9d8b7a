"""Bronze: landed text cast to contract types; no cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.casting import null_safe_cast
from tallyspark.sources.contracts import FeedContract

META_COLUMNS = ("_loaded_at", "_source_file", "_batch_id", "_source_system")


def typed(raw: DataFrame, contract: FeedContract) -> DataFrame:
    """Contract columns cast NULL-safely, load metadata carried along."""
    cast = [null_safe_cast(F.col(c.name), c.dtype, c.scale).alias(c.name) for c in contract.columns]
    meta = [F.col("_loaded_at").try_cast("timestamp").alias("_loaded_at"), *META_COLUMNS[1:]]
    return raw.select(*cast, *meta)
