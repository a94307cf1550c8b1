"""Keyed streaming state: one processor that runs the same step functions as the batch folds."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

from tidewatch.operators.bursts import SECOND

Wake = Callable[[dict], int | None]


def rows_of(rows: Iterator[Row], columns: Sequence[str], order: Sequence[str]) -> list[dict]:
    """All rows of one key in a micro-batch, in event order, missing values last."""
    found = [dict(zip(columns, row, strict=True)) for row in rows]
    return sorted(found, key=lambda r: [(r[c] is None, 0 if r[c] is None else r[c]) for c in order]) if len(found) > 1 else found


class FoldProcessor(StatefulProcessor):
    """Run ``step(state, row)`` over each key's rows in event order, keeping the state between micro-batches.

    ``inputs`` and ``columns`` name the columns of the rows that come in and go out.

    ``wake`` gives the time (microseconds) at which the state needs attention without input, or None;
    ``expire(state, now)`` then returns the rows due at that time. A state with nothing to wake for is dropped.
    """

    def __init__(
        self,
        step: Callable[[dict, dict], list[dict]],
        inputs: Sequence[str],
        columns: Sequence[str],
        order: Sequence[str] = ("_at", "seq"),
        wake: Wake | None = None,
        expire: Callable[[dict, int], list[dict]] | None = None,
    ):
        self.step, self.order = step, list(order)
        self.inputs, self.columns = list(inputs), list(columns)
        self.row = Row(*self.columns)
        self.wake, self.expire = wake, expire

    def init(self, handle) -> None:
        self.handle = handle
        self.saved = handle.getValueState("fold", "state string")

    def _timer(self, state: dict) -> int | None:
        """The time (milliseconds) of the state's one timer."""
        due = self.wake(state) if self.wake else None
        return None if due is None else -(-due // 1000)

    def _load(self) -> dict | None:
        saved = self.saved.get()
        return None if saved is None else json.loads(saved[0])

    # Each call on the state or a timer is a round trip to the JVM, so only those that change something are made.
    def _store(self, state: dict, known: bool, timer: int | None) -> None:
        """Keep the state; ``known`` tells whether there was one before, ``timer`` what it waited for."""
        due = self._timer(state)
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if self.wake and due is None:
            if known:
                self.saved.clear()
            return
        self.saved.update((json.dumps(state),))
        if due is not None and due != timer:
            self.handle.registerTimer(due)

    def _rows(self, out: list[dict]) -> Iterator[Row]:
        for r in out:
            yield self.row(*[r.get(c) for c in self.columns])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        found, out = self._load(), []
        state = {} if found is None else found
        timer = self._timer(state)
        for row in rows_of(rows, self.inputs, self.order):
            out += self.step(state, row)
        self._store(state, found is not None, timer)
        yield from self._rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        state = self._load()
        if state is None:
            return
        timer = self._timer(state)
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        out = self.expire(state, now) if self.expire else []
        self._store(state, True, timer)
        yield from self._rows(out)

    def close(self) -> None:
        pass


def rolling_step(state: dict, row: dict, n: int, values: dict[str, str]) -> list[dict]:
    """Average of the last ``n`` values of each column, as ``<short>_avg_<n>``."""
    out = dict(row)
    for column, short in values.items():
        last = [*state.get(column, []), row[column]][-n:]
        state[column] = last
        # Added left to right like the batch form; the built-in sum of floats compensates its error.
        out[f"{short}_avg_{n}"] = reduce(add, last, 0.0) / len(last)
    return [out]


def burst_step(state: dict, row: dict, window_sec: int, threshold: int) -> list[dict]:
    """Times of the recent errors; the row that makes them ``threshold`` fires and empties the list."""
    now = row["_at"]
    recent = [t for t in state.get("times", []) if t >= now - window_sec * SECOND]
    recent.append(now)
    fired = len(recent) >= threshold
    state["times"] = [] if fired else recent
    return [row] if fired else []
