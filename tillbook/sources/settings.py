"""Session settings that hold for one write."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: A write gives back the disk of its shuffles when it ends, not when the driver's garbage is collected.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Rows go to the folders of two partitions as they come, without a sort.
TWO_FOLDERS = {"spark.sql.maxConcurrentOutputFileWriters": "2"}


def listing(spark: SparkSession) -> dict[str, str]:
    """Many files are looked up by a few tasks per core, not by one task each."""
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The settings, until the end of the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
