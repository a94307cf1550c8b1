"""Ordered fold per key, for state machines that no built-in expression covers.

Rows are cut into sorted blocks (see ``blocks``), so memory stays at one Arrow batch and a hot key is
spread over tasks. What a block has to know is the state that the blocks before it end in, and only a key of more than one
block has any. Two ways to learn it:

* With ``transition`` every block that lies inside one key is summarized, in one job, as a function from the state it is entered
  with to the state it ends in; the driver, which has one such function per block, puts them together. A function may give up on a rare state; just that
  block is then folded from it.
* Without, all blocks fold at once from the state their predecessor is believed to end in, starting with "nothing seen", and a block
  is folded again only when that belief turns out wrong. A key within one or two blocks settles in two rounds; for a key of many blocks it
  depends on how fast its state forgets the past.

Either way the result equals the sequential fold.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.blocks import BLOCK, arrow_schema, key_at, key_fields, key_starts, non_empty, sorted_blocks

State = dict
Step = Callable[[State, dict], list[dict]]  # changes the state, returns output rows
Finish = Callable[[State], list[dict]]


class Transition(Protocol):
    """What a run of one key's rows does to the state it is entered with."""

    def summarize(self, rows: Iterable[Mapping]) -> dict | None:
        """The function as something JSON can hold, or None where it would be too large."""

    def apply(self, summary: dict, state: State) -> State | None:
        """The state behind the rows, or None where only a fold can tell."""


def block_fold(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Step,
    finish: Finish,
    out_schema: T.StructType,
    blocks: int | None = None,
    transition: Transition | None = None,
) -> DataFrame:
    """Run ``step`` over each key's rows in order, from an empty state, and ``finish`` after its last row.

    The state must be a dict that JSON can hold. ``step`` and ``finish`` must be deterministic.
    """
    cut = sorted_blocks(df, keys, order, blocks)
    out_arrow = arrow_schema(out_schema)
    end_schema = T.StructType(
        [
            T.StructField(BLOCK, T.IntegerType()),
            T.StructField("single", T.BooleanType()),
            T.StructField("state", T.StringType()),
            T.StructField("function", T.StringType()),
            *key_fields(cut, keys, "first_"),
            *key_fields(cut, keys, "last_"),
        ]
    )
    end_arrow = arrow_schema(end_schema)

    def fold(batches: Iterable[pa.RecordBatch], entering: dict[int, str], ending: set[int] | None):
        """Yield output rows per batch; with ``ending=None`` yield only the block's end state."""
        held: list[dict] = []  # rows of a block of one key, to be summarized
        first = key = None
        block = -1
        single = True
        state: State = {}
        for batch in non_empty(batches):
            if ending is None:
                # Only the rows of the block's last key decide its end state; keys that end before are passed over.
                starts = key_starts(batch, keys)
                begin = int(starts[-1])
                if first is None:
                    first = key = key_at(batch, keys, 0)
                    block = batch.column(BLOCK)[0].as_py()
                    state = json.loads(entering.get(block, "{}"))
                last = key_at(batch, keys, begin)
                if last != key:
                    key, state, single = last, {}, False
                rows = batch.slice(begin).to_pylist()
                if transition is not None and single and not entering:
                    held += rows
                else:
                    held.clear()
                for row in rows:
                    step(state, row)
                continue
            out: list[dict] = []
            for row in batch.to_pylist():
                k = tuple(row[c] for c in keys)
                if first is None:
                    first = key = k
                    block = row[BLOCK]
                    state = json.loads(entering.get(block, "{}"))
                elif k != key:
                    out += finish(state)
                    key, state, single = k, {}, False
                out += step(state, row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=out_arrow)
        if first is None:
            return
        if ending is None:
            function = transition.summarize(held) if held and single else None
            end = {BLOCK: block, "single": single, "state": json.dumps(state, sort_keys=True)}
            end["function"] = None if function is None else json.dumps(function)
            end |= {"first_" + c: v for c, v in zip(keys, first, strict=True)}
            end |= {"last_" + c: v for c, v in zip(keys, key, strict=True)}
            yield pa.RecordBatch.from_pylist([end], schema=end_arrow)
        elif block in ending:
            out = finish(state)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=out_arrow)

    def end_states(entering: dict[int, str], only: list[int] | None) -> dict[int, T.Row]:
        part = cut if only is None else cut.filter(F.col(BLOCK).isin(only))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return fold(batches, entering, None)

        return {r[BLOCK]: r for r in part.mapInArrow(run, end_schema).collect()}

    ends = end_states({}, None)
    chain = sorted(ends)
    begins = {b: p is None or any(ends[p]["last_" + c] != ends[b]["first_" + c] for c in keys) for p, b in zip([None, *chain], chain, strict=False)}
    ending = {b for b, after in zip(chain, [*chain[1:], None], strict=True) if after is None or begins[after]}

    def believed() -> tuple[dict[int, str], list[int]]:
        """(the state that each block is entered with, blocks whose own fold began with another one)."""
        entering = {b: ends[p]["state"] for p, b in zip(chain, chain[1:], strict=False) if not begins[b]}
        # Only a block with a single key passes on what it was given.
        return entering, [b for b in entering if ends[b]["single"] and entering[b] != used.get(b, "{}")]

    def composed() -> tuple[dict[int, str], list[int]]:
        """(the state that each block is entered with as far as it is known, blocks that must be folded from it to go on)."""
        entering: dict[int, str] = {}
        unknown: list[int] = []
        state: str | None = None
        for b in chain:
            if begins[b]:
                state = "{}"
            elif state is not None:
                entering[b] = state
            end = ends[b]
            if not end["single"] or (state is not None and state == used.get(b, "{}")):
                state = end["state"]
            elif state is not None:
                function = functions.get(b)
                after = None if function is None else transition.apply(function, json.loads(state))
                if after is None:
                    unknown.append(b)
                state = None if after is None else json.dumps(after, sort_keys=True)
        return entering, unknown

    used: dict[int, str] = {}
    functions = {b: json.loads(ends[b]["function"]) for b in chain if ends[b]["function"]}
    while True:
        entering, stale = believed() if transition is None else composed()
        if not stale:
            break
        used |= {b: entering[b] for b in stale}
        ends |= end_states({b: entering[b] for b in stale}, stale)

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fold(batches, entering, ending)

    return cut.mapInArrow(emit, out_schema)
