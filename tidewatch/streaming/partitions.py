"""How many partitions the state of a stream has.

Every partition of every stateful operator opens, writes and commits a store in every micro-batch, four of them for a join of streams, however few
rows there are. The number is fixed when a stream first starts. What batch jobs need for many rows is then mostly time spent on files.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PARTITIONS = "spark.sql.shuffle.partitions"


def state_partitions(spark: SparkSession) -> int:
    """Two for each task that can run at once, and no more than ``spark.sql.shuffle.partitions``."""
    return min(int(spark.conf.get(PARTITIONS)), 2 * max(spark.sparkContext.defaultParallelism, 4))


@contextmanager
def few_partitions(spark: SparkSession) -> Iterator[None]:
    """Streams that first start inside have ``state_partitions``; what they take from the session they take at their start."""
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(state_partitions(spark)))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, before)
