"""Joins whose small side is measured before it is broadcast, and joins that hold when a few keys own a large part of the rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 << 20
# A key with at least one row in this many is hot. There can't be more hot keys than this, so what belongs to them may be broadcast.
HOT_PARTS = 1000


def row_bytes(df: DataFrame) -> Column:
    """About the size of a row: the lengths of its texts, and a fixed size for other plain columns."""
    size = F.lit(16)
    for f in df.schema.fields:
        name = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            size = size + F.coalesce(F.octet_length(name.cast("string")), F.lit(0))
        else:
            size = size + 8
    return size


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows have at most ``max_bytes``. Every partition adds up its own rows."""
    return (df.agg(F.sum(row_bytes(df).cast("bigint"))).first()[0] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its rows have at most ``max_bytes``, else ``df`` for a shuffle join.

    Pass a frame that is cheap to read, such as one made from checkpointed blocks.
    """
    return F.broadcast(df) if is_small(df, max_bytes) else df


def hot_values(rows: DataFrame, columns: Sequence[Column], parts: int = HOT_PARTS) -> DataFrame:
    """``place, _key``: for each of the columns (of one type) the values that at least one row in ``parts`` has; checkpointed.

    One pass counts all columns. The result has at most ``parts`` values per column.
    """
    total = rows.count()
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), c.alias("_key")) for i, c in enumerate(columns)]))
    counts = rows.select(each.alias("v")).select("v.*").filter("_key IS NOT NULL").groupBy("place", "_key").agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") * parts >= F.lit(total)).select("place", "_key").checkpoint()


def look_up(rows: DataFrame, key: Column, table: DataFrame, hot: DataFrame, own: Column) -> DataFrame:
    """Left join with ``table`` (``_key`` and other columns, one row per key) when any key may hold a large part of the rows.

    Rows of a ``hot`` key (``_key``, few by arithmetic) find their values by broadcast. In the shuffle join that serves all others they, and rows
    without a key, take part under a key of their own, made from ``own``, so every row is read once and none piles up.
    """
    names = [c for c in table.columns if c != "_key"]
    known = hot.select("_key").distinct().join(table, "_key", "left")
    known = known.select(F.col("_key").alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in names])
    met = rows.withColumn("_key", key.cast("string")).join(F.broadcast(known), F.col("_key") == F.col("_hot"), "left")
    alone = F.col("_key").isNull() | F.col("_hot").isNotNull()
    met = met.withColumn("_spread", F.when(alone, own.cast("string"))).withColumn("_key", F.when(~alone, F.col("_key")))
    far = table.select(F.col("_key").alias("_far"), F.lit(None).cast("string").alias("_of"), *names)
    # The second part of the key keeps fillers apart from real keys.
    same = F.coalesce("_key", "_spread").eqNullSafe(F.col("_far")) & F.col("_spread").eqNullSafe(F.col("_of"))
    out = met.join(far, same, "left")
    found = [F.when(F.col("_hot").isNotNull(), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in names]
    return out.select(*rows.columns, *found)


def _number_copies(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``_part`` and ``_nth``: which partition a row lies in, and its number among equal keys there (from 1). Checkpointed."""
    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_nth", T.LongType())])

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        for batch in batches:
            nth = np.empty(batch.num_rows, dtype=np.int64)
            for i, key in enumerate(zip(*[batch.column(k).to_pylist() for k in keys], strict=True)):
                nth[i] = seen[key] = seen.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth)], names=[*batch.schema.names, "_nth"])

    marked = rows.withColumn("_part", F.spark_partition_id())
    return marked.mapInArrow(number, schema).checkpoint()


def picked_whole(rows: DataFrame, picked: DataFrame, keys: Sequence[str]) -> bool:
    """Whether of each picked key no row is left over. True for rows, it is true for any part of them. Reads the keys only."""
    times = picked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"))
    met = rows.select(*keys).join(broadcast_if_small(times), list(keys)).groupBy(*keys)
    return met.agg(F.count(F.lit(1)).alias("_n"), F.max("_times").alias("_times")).filter("_n > _times").isEmpty()


def picked_and_rest(rows: DataFrame, picked: DataFrame, keys: Sequence[str], whole: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that were picked, the other rows). ``picked`` holds the keys of a row as often as it was picked.

    Records delivered more than once have equal keys; of these as many are taken as were picked. Mostly all copies of a key were picked
    (``whole``, worked out if it is not given), and a row's key decides. Else the rows that meet a picked key are written once, with their number among the
    copies in their partition, and the counts of the partitions before tell how many a partition may take, so the copies of one record stay
    spread over all tasks. ``picked`` must be cheap to read.
    """
    times = picked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"))
    whole = picked_whole(rows, picked, keys) if whole is None else whole
    if is_small(picked.select(*keys)):
        met = rows.join(F.broadcast(times), list(keys))
        others = rows.join(F.broadcast(times), list(keys), "left_anti")
    else:
        def packed(df: DataFrame) -> Column:
            return F.when(~_any_null(keys), F.to_json(F.struct(*[F.col(k) for k in keys])))

        hot = hot_values(rows, [packed(rows)])
        marked = look_up(rows, packed(rows), times.select(packed(times).alias("_key"), "_times"), hot, F.monotonically_increasing_id())
        met, others = marked.filter("_times IS NOT NULL"), marked.filter("_times IS NULL")
    if whole:
        return met.select(*rows.columns), others.select(*rows.columns)
    numbered = _number_copies(met.select(*rows.columns, "_times"), keys)
    counts = numbered.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")).checkpoint()
    decided = numbered.join(broadcast_if_small(before), [*keys, "_part"])
    taken = F.col("_nth") + F.col("_before") <= F.col("_times")
    return decided.filter(taken).select(*rows.columns), others.select(*rows.columns).unionByName(decided.filter(~taken).select(*rows.columns))


def _any_null(columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull()
    return out
