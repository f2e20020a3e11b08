"""Settings of the session while something runs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is run meanwhile deletes its shuffle files when it ends, not when the driver happens to collect its garbage.

    Only for results that nothing reads a second time from the same plan, as those of a write.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
