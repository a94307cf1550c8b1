"""Greedy spacing: keep a row when it lies at least ``gap`` behind the last kept row of its key.

This one rule is behind three operators: error bursts (position = row number, gap = threshold), cooldowns
(position = time, gap = cooldown) and time-limited deduplication (position = time, gap = TTL).

The choice is sequential, so a hot key would run through one task. Instead the rows are cut into sorted
blocks (see ``blocks``) and each block is turned into a step function: "if the next allowed position is x,
the last kept position of this block is y". Chaining these functions over the blocks gives every block its
true starting point, and all blocks then pick their rows in parallel. The result is exact at any skew.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.blocks import (
    BLOCK,
    arrow_schema,
    key_at,
    key_fields,
    key_starts,
    last_known,
    non_empty,
    sorted_blocks,
)

GAP = "_gap"
# Steps that all blocks together may send to the driver, which then chains them at once. If there are more, the functions stay in a table and are
# composed there, pair by pair; the rows kept are the same.
SENT_STEPS = 100_000
# An entry before every position.
_EARLIEST = -(1 << 61)


def _step_function(pos: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """(upper, last): a chain whose next allowed position is at most ``upper[j]`` ends at ``last[j]``."""
    n = len(pos)
    rows = np.arange(n)
    follow = np.maximum(np.searchsorted(pos, pos + gap, side="left"), rows + 1)
    end = np.where(follow < n, follow, rows)
    while True:
        further = end[end]
        if np.array_equal(further, end):
            break
        end = further
    # Earlier blocks end at or before pos[0], so no chain enters behind the first row at pos[0] + gap.
    entries = int(np.searchsorted(pos, pos[0] + gap, side="left")) + 1
    upper, last = pos[:entries], pos[end[:entries]]
    keep = np.append(last[1:] != last[:-1], True)
    return upper[keep], last[keep]


def _pick(pos: np.ndarray, gap: int, last: int | None) -> tuple[list[int], int | None]:
    """Indices kept in one sorted run, and the last kept position."""
    picked: list[int] = []
    i = 0 if last is None else int(np.searchsorted(pos, last + gap, side="left"))
    while i < len(pos):
        picked.append(i)
        last = int(pos[i])
        i = max(i + 1, int(np.searchsorted(pos, last + gap, side="left")))
    return picked, last


def _steps(blocks: DataFrame, keys: Sequence[str], pos: str, nodes: dict[int, tuple[int, int]]) -> DataFrame:
    """``chain, idx, upper, last, bound``: the step functions of single-key blocks as rows; ``nodes`` places a block in its chain.

    No chain enters a block behind ``bound``: the last position kept before lies at or before the block's first one.
    """

    def functions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []  # positions of one block
        block = gap = 0
        for batch in non_empty(batches):
            block, gap = batch.column(BLOCK)[0].as_py(), batch.column(GAP)[0].as_py()
            parts.append(batch.column(pos).to_numpy(zero_copy_only=False).astype(np.int64))
        if parts and block in nodes:
            whole = np.concatenate(parts)
            upper, last = _step_function(whole, gap)
            chain, idx = nodes[block]
            same = [np.full(len(upper), x, dtype=np.int64) for x in (chain, idx, int(whole[0]) + gap)]
            columns = [same[0], same[1], upper, last, same[2]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["chain", "idx", "upper", "last", "bound"])

    return blocks.select(*dict.fromkeys([*keys, pos, GAP, BLOCK])).mapInArrow(functions, _STEPS)


_STEPS = "chain long, idx long, upper long, last long, bound long"


def _composed(steps: DataFrame, gaps: dict[int, int], blocks: int | None) -> DataFrame:
    """Each two neighbours as one function, with half the ``idx``.

    Where a step of the left function ends asks the right one for its first step at or behind the next allowed position: an as-of join in
    sorted blocks, so the steps of one key spread over all tasks. Of the right function only the steps behind all of the left one stay, and
    these only where a chain may enter so late.
    """
    spark = steps.sparkSession
    gap = F.broadcast(spark.createDataFrame(list(gaps.items()), "chain long, gap long"))  # one row per chain of blocks
    half = F.floor(F.col("idx") / 2).cast("bigint").alias("half")
    left, right = steps.filter("idx % 2 = 0"), steps.filter("idx % 2 = 1")
    asked = left.join(gap, "chain").select("chain", half, (-(F.col("last") + F.col("gap"))).alias("_back"), F.lit(1).alias("_asks"), "upper", "last", "bound", F.lit(None).cast("bigint").alias("_goal"))
    given = right.select("chain", half, (-F.col("upper")).alias("_back"), F.lit(0).alias("_asks"), "upper", "last", "bound", F.col("last").alias("_goal"))
    # From the last position back, so the step seen last is the first one at or behind the asked position.
    met = last_known(asked.unionByName(given), ["chain", "half"], ["_back", "_asks", "upper"], "_goal", "_reached", blocks)
    ends = left.groupBy("chain", half).agg(F.max("upper").alias("_most"), F.max("bound").alias("_bound"))  # one row per node
    met = met.join(F.broadcast(ends), ["chain", "half"], "left")
    stays = (F.col("_asks") == 1) | F.col("_most").isNull() | ((F.col("upper") > F.col("_most")) & (F.col("_bound") > F.col("_most")))
    last = F.when(F.col("_asks") == 1, F.coalesce("_reached", "last")).otherwise(F.col("last"))
    return met.filter(stays).select("chain", F.col("half").alias("idx"), "upper", last.alias("last"), F.coalesce("_bound", "bound").alias("bound"))


def _exits(steps: DataFrame, entries: dict[tuple[int, int], int], gaps: dict[int, int]) -> dict[tuple[int, int], int]:
    """The next allowed position behind each (chain, idx) that is entered at the given one."""
    asked = steps.sparkSession.createDataFrame([(c, i, x) for (c, i), x in entries.items()], "chain long, idx long, entry long")
    met = steps.join(F.broadcast(asked), ["chain", "idx"]).filter("upper >= entry")
    found = met.groupBy("chain", "idx").agg(F.min_by("last", "upper").alias("last")).collect()
    return entries | {(r["chain"], r["idx"]): r["last"] + gaps[r["chain"]] for r in found}


def _walk(steps: DataFrame, starts: dict[int, int], sizes: dict[int, int], gaps: dict[int, int], blocks: int | None) -> tuple[dict, dict]:
    """(entry, exit) of every (chain, idx): functions are composed pairwise upwards, then entries are handed down.

    A few short jobs per level, and as many levels as the logarithm of the longest chain.
    """
    levels = [steps.checkpoint()]
    counts = [sizes]
    while max(counts[-1].values()) > 1:
        levels.append(_composed(levels[-1], gaps, blocks).checkpoint())
        counts.append({c: -(-n // 2) for c, n in counts[-1].items()})
    entries = {(c, 0): x for c, x in starts.items()}
    for level in range(len(levels) - 2, -1, -1):
        lefts = {(c, 2 * i): x for (c, i), x in entries.items()}
        behind = _exits(levels[level], lefts, gaps)
        rights = {(c, i + 1): x for (c, i), x in behind.items() if i + 1 < counts[level][c]}
        entries = lefts | rights
    return entries, _exits(levels[0], entries, gaps)


def _summaries(blocks: DataFrame, keys: Sequence[str], pos: str, max_steps: int) -> list:
    def summarize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last_key = None
        block = gap = 0
        single = True
        parts: list[np.ndarray] = []  # positions of the first key; bounded by the block
        last: int | None = None
        for batch in non_empty(batches):
            starts = key_starts(batch, keys)
            positions = batch.column(pos).to_numpy(zero_copy_only=False).astype(np.int64)
            gaps = batch.column(GAP).to_numpy(zero_copy_only=False)
            for begin, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                key = key_at(batch, keys, int(begin))
                if first is None:
                    first = last_key = key
                    block = batch.column(BLOCK)[0].as_py()
                if key != last_key:
                    single, last_key, last, parts = False, key, None, []
                gap = int(gaps[begin])
                if single:
                    parts.append(positions[begin:end])
                else:
                    _, last = _pick(positions[begin:end], gap, last)
        if first is None:
            return
        upper, ends = _step_function(np.concatenate(parts), gap) if single else (np.array([]), np.array([]))
        small = len(upper) <= max_steps
        row = {
            BLOCK: block,
            "single": single,
            "last": last,
            "gap": gap,
            "complete": small,
            "upper": [int(x) for x in upper] if small else [],
            "ends": [int(x) for x in ends] if small else [],
        }
        row |= {"first_" + k: v for k, v in zip(keys, first, strict=True)}
        row |= {"last_" + k: v for k, v in zip(keys, last_key, strict=True)}
        yield pa.RecordBatch.from_pylist([row], schema=arrow)

    schema = T.StructType(
        [
            T.StructField(BLOCK, T.IntegerType()),
            T.StructField("single", T.BooleanType()),
            T.StructField("last", T.LongType()),
            T.StructField("gap", T.LongType()),
            T.StructField("complete", T.BooleanType()),
            T.StructField("upper", T.ArrayType(T.LongType())),
            T.StructField("ends", T.ArrayType(T.LongType())),
            *key_fields(blocks, keys, "first_"),
            *key_fields(blocks, keys, "last_"),
        ]
    )
    arrow = arrow_schema(schema)
    rows = blocks.select(*dict.fromkeys([*keys, pos, GAP, BLOCK])).mapInArrow(summarize, schema).collect()
    return sorted(rows, key=lambda r: r[BLOCK])


def greedy_spacing(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    ties: Sequence[str],
    gap: int | Column,
    blocks: int | None = None,
    max_steps: int = SENT_STEPS,
    presorted: bool = False,
) -> DataFrame:
    """Rows kept by the greedy rule, in (keys, pos, ties) order, first row of a key always kept.

    ``pos`` is a bigint column and ``gap`` a number or a bigint column that is constant within a key.
    ``presorted`` rows already lie in materialized blocks of this order and carry their block number.
    """
    gap_col = F.lit(gap) if isinstance(gap, int) else gap
    cut = df.withColumn(GAP, F.greatest(gap_col.cast("bigint"), F.lit(0).cast("bigint")))
    if not presorted:
        cut = sorted_blocks(cut, keys, [pos, *ties], blocks)
    sent = max_steps // (blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    summaries = _summaries(cut, keys, pos, sent)
    out_schema = T.StructType([f for f in df.schema.fields if f.name != BLOCK])
    kept = out_schema.names

    def select(batches: Iterable[pa.RecordBatch], entering: dict[int, int]) -> Iterator[pa.RecordBatch]:
        running = last = None
        fresh = True
        for batch in non_empty(batches):
            starts = key_starts(batch, keys)
            positions = batch.column(pos).to_numpy(zero_copy_only=False).astype(np.int64)
            gaps = batch.column(GAP).to_numpy(zero_copy_only=False)
            if fresh:
                running, last = key_at(batch, keys, 0), entering.get(batch.column(BLOCK)[0].as_py())
                fresh = False
            rows: list[int] = []
            for begin, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                key = key_at(batch, keys, int(begin))
                if key != running:
                    running, last = key, None
                picked, last = _pick(positions[begin:end], int(gaps[begin]), last)
                rows += [int(begin) + i for i in picked]
            if rows:
                yield batch.select(kept).take(pa.array(rows, type=pa.int64()))

    entering: dict[int, int] = {}
    if all(s["complete"] for s in summaries):
        running = last = None
        for s in summaries:
            first = tuple(s["first_" + k] for k in keys)
            if running != first:
                last = None
            elif last is not None:
                entering[s[BLOCK]] = last
            if not s["single"]:
                last = s["last"]
            else:
                j = 0 if last is None else bisect_left(s["upper"], last + s["gap"])
                last = s["ends"][j] if j < len(s["ends"]) else last
            running = tuple(s["last_" + k] for k in keys)
    else:
        # Neighbouring blocks of one key are a chain. What enters a chain is known: its key began in the block before, or begins here.
        nodes: dict[int, tuple[int, int]] = {}
        starts: dict[int, int] = {}
        sizes: dict[int, int] = {}
        gaps: dict[int, int] = {}
        follows: list[tuple[int, int]] = []  # a block of several keys, and the chain that its first key goes on from
        running = last = chain = None
        for s in summaries:
            first = tuple(s["first_" + k] for k in keys)
            if running != first:
                last = chain = None
            if s["single"]:
                if chain is None:
                    chain = len(starts)
                    starts[chain], sizes[chain], gaps[chain] = _EARLIEST if last is None else last + s["gap"], 0, s["gap"]
                nodes[s[BLOCK]] = (chain, sizes[chain])
                sizes[chain] += 1
            else:
                if chain is not None:
                    follows.append((s[BLOCK], chain))
                elif last is not None:
                    entering[s[BLOCK]] = last
                last, chain = s["last"], None
            running = tuple(s["last_" + k] for k in keys)
        entries, exits = _walk(_steps(cut, keys, pos, nodes), starts, sizes, gaps, blocks)
        for block, (c, i) in nodes.items():
            if entries[c, i] != _EARLIEST:
                entering[block] = entries[c, i] - gaps[c]
        for block, c in follows:
            entering[block] = exits[c, sizes[c] - 1] - gaps[c]

    return cut.mapInArrow(lambda it: select(it, entering), out_schema)
