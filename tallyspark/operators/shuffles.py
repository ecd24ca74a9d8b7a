"""What a query's shuffles leave on disk.

Spark keeps the shuffle files of a query until the driver's JVM happens to collect its plan, so a build of many steps
holds the shuffles of all of them. A step whose result is stored needs its own no longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

#: A plan takes this setting as it stands when the frame is made, not when it runs. Run again, it makes its shuffles anew.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str | None) -> Iterator[None]:
    """A session's setting for the time being; as it is where the value is None."""
    if value is None:
        yield
        return
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def released_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Frames made in here delete their shuffle files as soon as a query on them has ended; others are as before."""
    return setting(spark, RELEASE, "true")
