"""Ordered row operators that hold at any key size.

A window function with ``partitionBy(service)`` sorts all rows of one service in one task, and one
with no key sorts everything in one task. These operators instead range-partition the rows by
(keys, order), so a hot key spreads over many tasks, and work as a parallel scan:

1. every block (= sorted partition) reports a short summary of its last rows,
2. the summaries, one row per block, are chained into what each block has to know of the rows before it,
3. every block is read again and finishes its rows with that carry.

Range boundaries are sampled, so two evaluations of the same plan may cut at different places. The
sorted rows are therefore written once with ``checkpoint()``; a lost executor re-reads the same blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import shared_dir

BLOCK = "_block"


def sorted_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """Range-partition by (keys, order), sort each partition, number the partitions, and materialize.

    The block count defaults to ``spark.sql.shuffle.partitions``; size it so that one block fits a task.
    Keys and order columns must not be null; a time as key goes in as microseconds.
    """
    spark = df.sparkSession
    shared_dir(spark)
    n = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [*keys, *order]
    return (
        df.repartitionByRange(n, *cols)
        .sortWithinPartitions(*cols)
        .withColumn(BLOCK, F.spark_partition_id())
        .checkpoint()
    )


def unplaced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that have no place in an order because one of the columns is null; the ordered operators leave them out."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return df.filter(missing)


def key_starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Positions in the batch at which a run of equal keys begins; position 0 is always one."""
    n = batch.num_rows
    change = np.zeros(n, dtype=bool)
    if n:
        change[0] = True
    for k in keys:
        col = batch.column(k)
        if n > 1:
            change[1:] |= pc.not_equal(col.slice(1), col.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(change)


def key_at(batch: pa.RecordBatch, keys: Sequence[str], i: int) -> tuple:
    return tuple(batch.column(k)[i].as_py() for k in keys)


def non_empty(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in batches if b.num_rows)


def key_fields(df: DataFrame, keys: Sequence[str], prefix: str) -> list[T.StructField]:
    return [T.StructField(prefix + k, df.schema[k].dataType) for k in keys]


def number_matrix(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """The named numeric columns as a (columns x rows) float matrix."""
    if not columns:
        return np.empty((0, batch.num_rows))
    return np.vstack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in columns])


@dataclass(frozen=True)
class Carry:
    """What a block knows of the rows of its first key that lie in earlier blocks."""

    key: tuple
    count: int  # rows, or their total weight
    tail: np.ndarray  # (columns x up to ``depth`` last rows)


def weights(batch: pa.RecordBatch, weight: str | None) -> np.ndarray:
    if weight is None:
        return np.ones(batch.num_rows, dtype=np.int64)
    return batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)


def _collect_carries(
    blocks: DataFrame, keys: Sequence[str], values: Sequence[str], depth: int, weight: str | None
) -> dict[int, Carry]:
    """One summary row per block (at most ``depth`` values per column), chained in block order."""

    def summarize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        block = count = 0
        single = True
        tail = np.empty((len(values), 0))
        for batch in non_empty(batches):
            starts = key_starts(batch, keys)
            head = key_at(batch, keys, 0)
            if first is None:
                first, last, block = head, head, batch.column(BLOCK)[0].as_py()
            rows, size = number_matrix(batch, values), weights(batch, weight)
            if head != last or len(starts) > 1:
                single = False
                begin = int(starts[-1])
                last, count, tail = key_at(batch, keys, begin), int(size[begin:].sum()), rows[:, begin:]
            else:
                count += int(size.sum())
                tail = np.hstack([tail, rows])
            tail = tail[:, max(0, tail.shape[1] - depth) :]
        if first is not None:
            row = {BLOCK: block, "single": single, "count": count, "tail": [list(map(float, r)) for r in tail]}
            row |= {"first_" + k: v for k, v in zip(keys, first, strict=True)}
            row |= {"last_" + k: v for k, v in zip(keys, last, strict=True)}
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    schema = T.StructType(
        [
            T.StructField(BLOCK, T.IntegerType()),
            T.StructField("single", T.BooleanType()),
            T.StructField("count", T.LongType()),
            T.StructField("tail", T.ArrayType(T.ArrayType(T.DoubleType()))),
            *key_fields(blocks, keys, "first_"),
            *key_fields(blocks, keys, "last_"),
        ]
    )
    arrow = arrow_schema(schema)
    needed = dict.fromkeys([*keys, *values, *([weight] if weight else []), BLOCK])
    rows = blocks.select(*needed).mapInArrow(summarize, schema).collect()

    carries: dict[int, Carry] = {}
    running: Carry | None = None
    for r in sorted(rows, key=lambda r: r[BLOCK]):
        first = tuple(r["first_" + k] for k in keys)
        last = tuple(r["last_" + k] for k in keys)
        tail = np.array(r["tail"], dtype=float).reshape(len(values), len(r["tail"][0]) if values else 0)
        continued = running is not None and running.key == first
        if continued:
            carries[r[BLOCK]] = running
        if continued and r["single"]:
            joined = np.hstack([running.tail, tail])
            running = Carry(last, running.count + r["count"], joined[:, max(0, joined.shape[1] - depth) :])
        else:
            running = Carry(last, r["count"], tail)
    return carries


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _scan(
    blocks: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    depth: int,
    compute,
    added: list[T.StructField],
    weight: str | None = None,
    keep_block: bool = False,
) -> DataFrame:
    """Append the columns that ``compute(rows, start, rank, offset)`` gives for each row.

    ``rows`` holds the batch's values behind the carried ones, ``offset`` is the number of carried rows,
    ``start`` gives each row's first row of the same key, ``rank`` the rows (or weight) of the key up to it.
    """
    carries = _collect_carries(blocks, keys, values, depth, weight)
    passed = [f for f in blocks.schema.fields if keep_block or f.name != BLOCK]
    out_schema = T.StructType([*passed, *added])
    kept = [f.name for f in passed]
    added_arrow = arrow_schema(T.StructType(added))

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running: Carry | None = None
        fresh = True
        for batch in non_empty(batches):
            if fresh:
                running, fresh = carries.get(batch.column(BLOCK)[0].as_py()), False
            n = batch.num_rows
            starts = key_starts(batch, keys)
            continued = running is not None and running.key == key_at(batch, keys, 0)
            rows = number_matrix(batch, values)
            offset, base0 = 0, 0
            if continued:
                rows = np.hstack([running.tail, rows])
                offset, base0 = running.tail.shape[1], running.count
            first_row = np.zeros(n, dtype=np.int64)
            first_row[starts] = starts
            first_row = np.maximum.accumulate(first_row)
            size = weights(batch, weight)
            upto = np.cumsum(size)
            rank = upto - (upto - size)[first_row] + np.where(first_row == 0, base0, 0)
            start = np.where(first_row == 0, 0, first_row + offset)
            new = compute(rows, start, rank, offset)
            arrays = [batch.column(c) for c in kept]
            arrays += [pa.array(v, type=f.type, from_pandas=True) for v, f in zip(new, added_arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *added_arrow.names])
            begin = int(starts[-1])
            tail = rows[:, begin + offset :] if begin else rows
            running = Carry(key_at(batch, keys, begin), int(rank[-1]), tail[:, max(0, tail.shape[1] - depth) :])

    return blocks.mapInArrow(apply, out_schema)


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, Sequence[str]],
    n: int,
    blocks: int | None = None,
) -> DataFrame:
    """Statistics over the last ``n`` rows of the key, the current row included.

    ``columns`` maps a value column to the wanted statistics among avg, max, min and size; the result of
    ``cpu: [avg]`` is column ``cpu_avg``. Fewer than ``n`` rows at the start give a partial window.
    """
    values = list(columns)
    wanted = [(i, stat) for i, c in enumerate(values) for stat in columns[c]]
    added = [
        T.StructField(f"{values[i]}_{stat}", T.LongType() if stat == "size" else T.DoubleType())
        for i, stat in wanted
    ]

    def compute(rows: np.ndarray, start: np.ndarray, rank: np.ndarray, offset: int) -> list[np.ndarray]:
        pos = np.arange(len(start)) + offset
        size = np.minimum(rank, n)
        total = np.zeros((len(values), len(start)))
        high = np.full_like(total, -np.inf)
        low = np.full_like(total, np.inf)
        for back in range(n - 1, -1, -1):
            at = pos - back
            inside = at >= start
            x = rows[:, np.maximum(at, 0)]
            total += np.where(inside, x, 0.0)
            high = np.maximum(high, np.where(inside, x, -np.inf))
            low = np.minimum(low, np.where(inside, x, np.inf))
        by_name = {"avg": total / size, "max": high, "min": low}
        return [size if stat == "size" else by_name[stat][i] for i, stat in wanted]

    return _scan(sorted_blocks(df, keys, order, blocks), keys, values, n - 1, compute, added)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rn",
    lag_of: str | None = None,
    lag: int = 1,
    lag_name: str = "lagged",
    blocks: int | None = None,
    keep_block: bool = False,
) -> DataFrame:
    """Row number per key in the given order (from 1) and, on demand, ``lag_of`` as it was ``lag`` rows before.

    ``lag_of`` must be a bigint column below 2^53, such as microseconds since the epoch. ``keep_block``
    leaves the block number in, for a following operator that works on the same sorted blocks.
    """
    values = [lag_of] if lag_of else []
    added = [T.StructField(name, T.LongType())]
    if lag_of:
        added.append(T.StructField(lag_name, T.LongType()))

    def compute(rows: np.ndarray, start: np.ndarray, rank: np.ndarray, offset: int) -> list[np.ndarray]:
        if not lag_of:
            return [rank]
        if not lag:
            return [rank, rows[0][offset:].astype(np.int64)]
        at = np.arange(len(start)) + offset - lag
        inside = at >= start
        old = np.where(inside, rows[0][np.maximum(at, 0)], 0).astype(np.int64)
        return [rank, np.ma.masked_array(old, mask=~inside)]

    depth = lag if lag_of else 0
    cut = sorted_blocks(df, keys, order, blocks)
    return _scan(cut, keys, values, depth, compute, added, keep_block=keep_block)


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str, name: str, blocks: int | None = None
) -> DataFrame:
    """Sum of the bigint column ``weight`` over the rows of the key up to and including this one."""

    def compute(rows: np.ndarray, start: np.ndarray, rank: np.ndarray, offset: int) -> list[np.ndarray]:
        return [rank]

    cut = sorted_blocks(df, keys, order, blocks)
    return _scan(cut, keys, [], 0, compute, [T.StructField(name, T.LongType())], weight)


def last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, blocks: int | None = None
) -> DataFrame:
    """The bigint column ``value`` of the last row up to and including this one, in the key, where it is not null.

    With two kinds of rows in one order, this is an as-of join: rows that ask have no value of their own.
    """
    cut = sorted_blocks(df, keys, order, blocks)
    end_schema = T.StructType(
        [
            T.StructField(BLOCK, T.IntegerType()),
            T.StructField("single", T.BooleanType()),
            T.StructField("value", T.LongType()),
            *key_fields(cut, keys, "first_"),
            *key_fields(cut, keys, "last_"),
        ]
    )
    end_arrow = arrow_schema(end_schema)

    def filled(batch: pa.RecordBatch, key: tuple | None, held: int | None) -> tuple[np.ndarray, np.ndarray, tuple]:
        """(values, where there is none, key of the last row); ``held`` is what is known of ``key`` before the batch."""
        column = batch.column(value)
        known = column.is_valid().to_numpy(zero_copy_only=False)
        values = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = key_starts(batch, keys)
        row = np.arange(batch.num_rows)
        first = np.zeros(batch.num_rows, dtype=np.int64)
        first[starts] = starts
        first = np.maximum.accumulate(first)
        source = np.maximum.accumulate(np.where(known, row, -1))
        inside = source >= first
        out = np.where(inside, values[np.maximum(source, 0)], 0)
        none = ~inside
        if held is not None and key == key_at(batch, keys, 0):
            early = none & (first == 0)
            out[early], none[early] = held, False
        return out, none, key_at(batch, keys, int(starts[-1]))

    def summarize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = key = held = None
        block, single = 0, True
        for batch in non_empty(batches):
            if first is None:
                first, block = key_at(batch, keys, 0), batch.column(BLOCK)[0].as_py()
            out, none, key = filled(batch, key, held)
            single = single and key == first
            held = None if none[-1] else int(out[-1])
        if first is not None:
            end = {BLOCK: block, "single": single, "value": held}
            end |= {"first_" + c: v for c, v in zip(keys, first, strict=True)}
            end |= {"last_" + c: v for c, v in zip(keys, key, strict=True)}
            yield pa.RecordBatch.from_pylist([end], schema=end_arrow)

    carries: dict[int, tuple] = {}
    running: tuple | None = None
    for r in sorted(cut.select(*keys, value, BLOCK).mapInArrow(summarize, end_schema).collect(), key=lambda r: r[BLOCK]):
        first, last = (tuple(r[side + c] for c in keys) for side in ("first_", "last_"))
        goes_on = running is not None and running[0] == first
        if goes_on:
            carries[r[BLOCK]] = running
        held = r["value"]
        if held is None and goes_on and r["single"]:
            held = running[1]
        running = (last, held)

    kept = [f.name for f in cut.schema.fields if f.name != BLOCK]
    schema = T.StructType([*[f for f in cut.schema.fields if f.name != BLOCK], T.StructField(name, T.LongType())])

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = held = None
        fresh = True
        for batch in non_empty(batches):
            if fresh:
                key, held = carries.get(batch.column(BLOCK)[0].as_py(), (None, None))
                fresh = False
            out, none, key = filled(batch, key, held)
            held = None if none[-1] else int(out[-1])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(out, mask=none)], names=[*kept, name])

    return cut.mapInArrow(apply, schema)
