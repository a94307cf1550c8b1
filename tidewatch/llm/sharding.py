"""Sharding by rendezvous hashing: every record draws a number for each shard and goes to the best one.

A record's draw for a shard depends on its key and the shard's name alone. Adding a shard therefore moves
only the records for which the new shard wins, and weights shift shares in proportion (score ``-weight / ln(u)``).
The shard count is a parameter, so the draws are one expression over a bounded array, and nothing is shuffled to place a
record. Slots (gapless numbers in a shard) come from one range shuffle of narrow rows and one count per block.

Defined cases: a null text has size 1 and the crc of no bytes; a very long text is measured whole; all null keys share one shard; rows with
the same key share a shard and get slots of their own, and any number of them spreads over several tasks; an empty table gives no rows; other
columns are not read by ``shard_documents`` and are written by ``write_shards``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import partitions, stored, text_of


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard with the best draw for a key; ``weights`` names the shards. Ties go to the smaller shard."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("every shard needs a positive weight")

    def draw(shard: int, weight: float) -> Column:
        # 52 bits of the hash as a number strictly between 0 and 1.
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12).cast("double") + 0.5) / float(1 << 52)
        return F.struct((-F.log(u) / float(weight)).alias("score"), F.lit(shard).alias("shard"))

    return F.array_min(F.array(*[draw(s, w) for s, w in sorted(weights.items())]))["shard"]


def with_slots(rows: DataFrame, shard: str, order: str) -> DataFrame:
    """Adds ``slot``: 0, 1, 2, ... in each shard by ``order``.

    Rows are ranged by (shard, order, a number that breaks ties), so a shard, and one value of ``order``, spreads over many tasks. A block knows where its shards begin from one
    count per (block, shard): at most blocks + shards rows, which is what is broadcast.
    """
    spark = rows.sparkSession
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(partitions(spark), shard, order, "tie").sortWithinPartitions(shard, order, "tie").drop("tie")
    numbered = stored(ranged.withColumn("nth", F.monotonically_increasing_id()).withColumn("block", F.spark_partition_id()), "slots")
    counts = numbered.groupBy("block", shard).agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
    before = F.sum("n").over(Window.partitionBy(shard).orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("block", shard, "first", F.coalesce(before, F.lit(0)).alias("before"))
    placed = numbered.join(F.broadcast(starts), ["block", shard])
    return placed.withColumn("slot", F.col("nth") - F.col("first") + F.col("before")).drop("block", "nth", "first", "before")


def shard_documents(
    docs: DataFrame,
    weights: Mapping[int, float],
    grown: Mapping[int, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``, and ``grown_shard``: the place among the shards ``grown``."""
    text = text_of(text_col)
    key = F.col(id_col)
    rows = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        rendezvous(key, weights).alias("shard"),
        (rendezvous(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    return with_slots(rows, "shard", "doc_id")


def write_shards(docs: DataFrame, path: str, weights: Mapping[int, float], id_col: str = "doc_id") -> None:
    """The documents as one folder per shard."""
    docs.withColumn("shard", rendezvous(F.col(id_col), weights)).write.partitionBy("shard").parquet(path)
