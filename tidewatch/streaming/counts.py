"""Counts per bucket, kept up to date from a stream, and windows answered from them.

Each micro-batch writes the counts of its own rows to one folder, ``batch=<id>`` below the table, by day. A batch that runs again
overwrites its folder with the same counts, so every row counts once, also after a restart; late rows add to their old bucket. A window sums
the buckets that it covers, whatever batch they came with, and reads only their days.

``merge_counts`` puts the batches so far into one folder, ``base=<id>``, which takes the place of all batches up to that id: readers use
the last base and the batches after it. The folder appears by a rename when it is complete, and what it replaces is deleted after that, so a failure at
any point leaves a table that reads the same, and a replaced batch that runs again is not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.timeline import bucket_counts
from tidewatch.sources.logstore import drop_folder, folders_of
from tidewatch.streaming.sinks import AVAILABLE_NOW, Trigger


def write_batch_counts(batch: DataFrame, batch_id: int, table: str, base_sec: int, by: Sequence[str], ts: str = "ts") -> None:
    """The counts of one micro-batch, in place of what an earlier run of it wrote."""
    counts = bucket_counts(batch, base_sec, by, ts).withColumn("dt", F.to_date("bucket"))
    counts.write.mode("overwrite").partitionBy("dt").parquet(f"{table}/batch={batch_id}")


def count_sink(
    df: DataFrame, table: str, checkpoint: str, base_sec: int = 60, by: Sequence[str] = (), ts: str = "ts", trigger: Trigger = AVAILABLE_NOW
) -> StreamingQuery:
    """Keep the counts of buckets of ``base_sec`` seconds per ``by`` values up to date."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch_counts(batch, batch_id, table, base_sec, by, ts)

    return df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _current(spark: SparkSession, table: str) -> tuple[list[str], int, list[str]]:
    """(folders that count, the last batch among them, folders that were replaced)."""
    found = {"batch": {}, "base": {}}
    for folder in folders_of(spark, table):
        kind, _, number = folder.getName().partition("=")
        if kind in found:
            found[kind][int(number)] = str(folder)
    base = max(found["base"], default=-1)
    count = [path for n, path in found["base"].items() if n == base] + [path for n, path in sorted(found["batch"].items()) if n > base]
    gone = [path for n, path in found["base"].items() if n < base] + [path for n, path in found["batch"].items() if n <= base]
    return count, max([base, *found["batch"]]), gone


def read_counts(spark: SparkSession, table: str, by: Sequence[str], start: Column | None = None, end: Column | None = None) -> DataFrame:
    """``bucket, by, n`` of the buckets in [start, end], one row per folder that met them. Other days are not opened."""
    fields = [T.StructField("bucket", T.TimestampType()), *[T.StructField(c, T.StringType()) for c in by], T.StructField("n", T.LongType())]
    schema = T.StructType([*fields, T.StructField("dt", T.DateType())])
    out = None
    for folder in _current(spark, table)[0]:
        part = spark.read.schema(schema).parquet(folder)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], T.StructType(fields))
    if start is not None:
        out = out.filter((F.col("dt") >= F.to_date(start)) & (F.col("bucket") >= start))
    if end is not None:
        out = out.filter((F.col("dt") <= F.to_date(end)) & (F.col("bucket") <= end))
    return out.drop("dt")


def merge_counts(spark: SparkSession, table: str, by: Sequence[str]) -> None:
    """Put all batches so far into one folder with one row per bucket and ``by`` values. Not while another merge runs."""
    count, last, gone = _current(spark, table)
    if len(count) > 1:
        summed = read_counts(spark, table, by).groupBy("bucket", *by).agg(F.sum("n").alias("n")).withColumn("dt", F.to_date("bucket"))
        draft, done = (spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{name}={last}") for name in ("_base", "base"))
        summed.write.mode("overwrite").partitionBy("dt").parquet(draft.toString())
        draft.getFileSystem(spark._jsc.hadoopConfiguration()).rename(draft, done)
        gone = [*gone, *count]
    for folder in gone:
        drop_folder(spark, folder)
