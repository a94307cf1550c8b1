"""Approvals: the life of an action from intent to its result."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalars import as_col, micros, micros_to_ts, normalize_decision
from tidewatch.operators.bursts import SECOND
from tidewatch.operators.folds import block_fold

# Message of each supported action; any other action fails.
ACTION_MESSAGES = {
    "SCALE_UP": "Scaled up {}",
    "ROLLING_RESTART": "Performed rolling restart on {}",
    "CLEAR_CACHE": "Cleared cache for {}",
    "RATE_LIMIT": "Applied rate-limiting for {}",
    "FAILOVER": "Triggered failover for {}",
}
UNSUPPORTED = "Unsupported action_type: {}"
PENDING_MESSAGE = "Awaiting human approval"
DENIED_MESSAGE = "Denied by approver"
EXPIRED_MESSAGE = "Approval timeout ({}s) exceeded"

PASSTHROUGH = ("incident_id", "test_id", "correlation_id", "rule_id", "source", "source_event_id")
TERMINAL = ("EXECUTED", "FAILED", "DENIED", "EXPIRED")

_INTENT = ("action_type", "target_service", *PASSTHROUGH)
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("action_id", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in _INTENT],
        T.StructField("status", T.StringType()),
        T.StructField("approver", T.StringType()),
        T.StructField("_at", T.LongType()),
    ]
)


def normalize_decisions(df: DataFrame) -> DataFrame:
    """Approvals with decision APPROVE or DENY; malformed ones and those without action id are dropped."""
    decision = normalize_decision("decision")
    return df.withColumn("decision", decision).filter(
        F.col("decision").isNotNull() & (F.coalesce("action_id", F.lit("")) != "")
    )


def route_actions(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(intents, approvals) of the actions topic; results and unknown events are left out."""
    kind = F.col("event_type")
    return df.filter(kind == "ACTION_INTENT"), df.filter(kind == "ACTION_APPROVAL")


def action_message(action_type: Column | str, target: Column | str) -> Column:
    """Outcome text of executing an action."""
    action_type, target = as_col(action_type), F.coalesce(as_col(target), F.lit("None"))
    out = None
    for name, text in ACTION_MESSAGES.items():
        lead, tail = text.split("{}")
        out = (F if out is None else out).when(action_type == name, F.concat(F.lit(lead), target, F.lit(tail)))
    lead, tail = UNSUPPORTED.split("{}")
    return out.otherwise(F.concat(F.lit(lead), F.coalesce(action_type, F.lit("None")), F.lit(tail)))


def to_results(df: DataFrame, pending_ttl: int = 900) -> DataFrame:
    """ACTION_RESULT records from state-machine output: action fields, ``status``, ``approver`` and ``_at``."""
    executed = F.col("status").isin("EXECUTED", "FAILED")
    lead, tail = EXPIRED_MESSAGE.split("{}")
    message = (
        F.when(executed, action_message("action_type", "target_service"))
        .when(F.col("status") == "PENDING_APPROVAL", PENDING_MESSAGE)
        .when(F.col("status") == "DENIED", DENIED_MESSAGE)
        .when(F.col("status") == "EXPIRED", f"{lead}{pending_ttl}{tail}")
    )
    return df.select(
        F.lit("ACTION_RESULT").alias("event_type"),
        "action_id",
        "action_type",
        "target_service",
        "status",
        message.alias("message"),
        F.floor(F.col("_at") / 1000).cast("bigint").alias("ts"),
        *PASSTHROUGH,
        F.when(executed, F.col("action_type")).alias("executed_action"),
        F.when(F.col("status") == "DENIED", F.col("approver")).alias("approver"),
        micros_to_ts("_at").alias("result_at"),
    )


class ApprovalMachine:
    """Life of one action id. The state is a dict with ``pending`` and ``done`` (times in microseconds)."""

    def __init__(self, require_approval: bool, pending_ttl: int, dedup_ttl: int, as_of: int | None = None):
        self.require_approval = require_approval
        self.pending_us = pending_ttl * SECOND
        self.dedup_us = dedup_ttl * SECOND
        self.as_of = as_of

    @staticmethod
    def _result(action: Mapping, status: str, at: int, approver: str | None = None) -> dict:
        return {**{c: action.get(c) for c in ("action_id", *_INTENT)}, "status": status, "approver": approver, "_at": at}

    def expire(self, state: dict, now: int) -> list[dict]:
        if state.get("done") is not None and now - state["done"] > self.dedup_us:
            del state["done"]
        pending = state.get("pending")
        if not self.require_approval or pending is None or now < pending["until"]:
            return []
        del state["pending"]
        state["done"] = pending["until"]
        return [self._result(pending["action"], "EXPIRED", pending["until"])]

    def _run(self, state: dict, action: Mapping, now: int) -> list[dict]:
        done = state.get("done")
        if done is not None and now - done <= self.dedup_us:
            return []
        state["done"] = now
        status = "EXECUTED" if action.get("action_type") in ACTION_MESSAGES else "FAILED"
        return [self._result(action, status, now)]

    def step(self, state: dict, row: Mapping) -> list[dict]:
        now = row["_at"]
        out = self.expire(state, now)
        if row["event_type"] == "ACTION_INTENT":
            if self.require_approval and row.get("status") != "APPROVED":
                done = state.get("done")
                if done is None or now - done > self.dedup_us:
                    action = {c: row.get(c) for c in ("action_id", *_INTENT)}
                    state["pending"] = {"action": action, "until": now + self.pending_us}
                    out.append(self._result(action, "PENDING_APPROVAL", now))
            else:
                out += self._run(state, row, now)
        elif self.require_approval and state.get("pending") is not None:
            action = state.pop("pending")["action"]
            if row["decision"] == "DENY":
                state["done"] = now
                out.append(self._result(action, "DENIED", now, row.get("approver")))
            else:
                out += self._run(state, action, now)
        return out

    def wake(self, state: dict) -> int | None:
        """When the state changes by itself: at expiry, or when its result no longer blocks repeats."""
        times = []
        if state.get("pending") is not None:
            times.append(state["pending"]["until"])
        if state.get("done") is not None:
            times.append(state["done"] + self.dedup_us + 1)
        return min(times) if times else None

    def finish(self, state: dict) -> list[dict]:
        return [] if self.as_of is None else self.expire(state, self.as_of)


class ApprovalTransition:
    """What a run of events of one action does to the state before it, for ``folds.block_fold``.

    While a result blocks repeats, nothing else happens, so a state with a result is known by the first event behind its end, and
    what follows from an event on with nothing pending and nothing blocked does not depend on the past. These
    continuations are worked out once from the last event backwards. A pending action that enters is decided by an event, or expires first and
    is then a result like any other. The function is a list of times with the end states that hold up to them.
    """

    # End states that one block may send; a longer function is folded from the state itself.
    MOST = 2000

    def __init__(self, machine: ApprovalMachine):
        self.machine = machine

    def _kind(self, row: Mapping) -> str:
        if row["event_type"] == "ACTION_INTENT":
            return "ask" if self.machine.require_approval and row.get("status") != "APPROVED" else "run"
        return ("deny" if row["decision"] == "DENY" else "approve") if self.machine.require_approval else "none"

    def summarize(self, rows: Iterable[Mapping]) -> dict | None:
        rows = list(rows)
        at = [r["_at"] for r in rows]
        kind = [self._kind(r) for r in rows]
        n, ttl, blocks = len(rows), self.machine.pending_us, self.machine.dedup_us

        def following(wanted: tuple[str, ...]) -> list[int]:
            out = [n] * (n + 1)
            for i in range(n - 1, -1, -1):
                out[i] = i if kind[i] in wanted else out[i + 1]
            return out

        answer, intent = following(("approve", "deny")), following(("ask", "run"))
        # End states: (), (done,), or (pending event, done or None). free[i]: from event i on with nothing pending or blocked.
        free: list[tuple] = [()] * (n + 1)
        asked: list[tuple] = [()] * n

        def blocked(done: int, i: int) -> tuple:
            j = max(i, bisect_right(at, done + blocks))
            return (done,) if j >= n else free[j]

        def both(k: int, done: int, i: int) -> tuple:
            """Event k is pending and a result of time ``done`` blocks, before event i."""
            until = at[k] + ttl
            while True:
                first_answer, first_intent = answer[i], intent[max(i, bisect_right(at, done + blocks))]
                expiry, e = max(i, bisect_left(at, until)), min(first_answer, first_intent)
                if expiry <= e and expiry < n:
                    return blocked(until, expiry)
                if e >= n:
                    return (k, done)
                if first_answer < first_intent:
                    again = kind[e] == "approve" and at[e] - done <= blocks
                    return blocked(done if again else at[e], e + 1)
                if kind[e] == "ask":
                    return asked[e]
                done, i = at[e], e + 1

        for i in range(n - 1, -1, -1):
            if kind[i] == "ask":
                e = i + 1
                if e >= n:
                    asked[i] = (i, None)
                elif at[e] >= at[i] + ttl:
                    asked[i] = blocked(at[i] + ttl, e)
                elif kind[e] == "ask":
                    asked[i] = asked[e]
                elif kind[e] == "run":
                    asked[i] = both(i, at[e], e + 1)
                else:
                    asked[i] = blocked(at[e], e + 1)
                free[i] = asked[i]
            elif kind[i] == "run":
                free[i] = blocked(at[i], i + 1)
            else:
                free[i] = free[i + 1]

        # An action asked before the first event is still pending behind the run event m, which ran: (when an event decides it, the end state then), or
        # (None, the time of the last run) if none does. Only an expiry before that moment could change it.
        kept: dict[int, tuple] = {}

        def undecided(done: int, i: int) -> tuple:
            first_answer, first_intent = answer[i], intent[max(i, bisect_right(at, done + blocks))]
            e = min(first_answer, first_intent)
            if e >= n:
                return None, done
            if first_answer < first_intent:
                again = kind[e] == "approve" and at[e] - done <= blocks
                return at[e], blocked(done if again else at[e], e + 1)
            return (at[e], asked[e]) if kind[e] == "ask" else kept[e]

        for m in range(n - 1, -1, -1):
            if kind[m] == "run":
                kept[m] = undecided(at[m], m + 1)

        # A result is not later than the first event, or than the expiry of what was asked before it.
        reach = bisect_right(at, at[0] + ttl + blocks)
        upto: list[int] = []
        ends: list[tuple] = []
        for j in range(min(reach + 1, n)):
            if ends and ends[-1] == free[j]:
                upto[-1] = at[j] - blocks
            elif not upto or at[j] - blocks > upto[-1]:
                upto.append(at[j] - blocks)
                ends.append(free[j])
        if len(ends) > self.MOST:
            return None

        def spelled(end: tuple) -> dict:
            state: dict = {}
            if len(end) == 2:
                k, done = end
                action = {c: rows[k].get(c) for c in ("action_id", *_INTENT)}
                state["pending"] = {"action": action, "until": at[k] + ttl}
            else:
                done = end[0] if end else None
            return state if done is None else {**state, "done": done}

        def told(found: tuple) -> dict:
            moment, end = found
            return {"at": None, "done": end} if moment is None else {"at": moment, "end": spelled(end)}

        # Pending and blocked at once: the first intent behind the blocked time decides, or an answer before it.
        r = answer[0]
        ahead = [m for m in range(min(r, n)) if kind[m] in ("ask", "run")]
        ahead = ahead[: bisect_right([at[m] for m in ahead], at[0] + blocks) + 1]
        if len(ahead) > self.MOST:
            return None
        decided = {"approve": (at[0], blocked(at[0], 1)), "deny": (at[0], blocked(at[0], 1)), "ask": (at[0], asked[0]), "run": kept.get(0)}.get(kind[0])
        return {
            "first": at[0],
            "last": at[-1],
            "whole": reach + 1 >= n,
            "upto": upto,
            "ends": [spelled(e) for e in ends],
            "free": spelled(free[0]),
            "decided": None if decided is None else told(decided),
            "intents": [[at[m] - blocks, told((at[m], asked[m]) if kind[m] == "ask" else kept[m])] for m in ahead],
            "answer": None if r >= n else {"at": at[r], "approve": kind[r] == "approve", "end": spelled(blocked(at[r], r + 1))},
        }

    def apply(self, summary: dict, state: dict) -> dict | None:
        first, done, pending = summary["first"], state.get("done"), state.get("pending")
        if done is not None and first - done > self.machine.dedup_us:
            done = None
        if pending is None:
            return self._after_result(summary, done)
        if not self.machine.require_approval:
            return None
        if first >= pending["until"]:
            return self._after_result(summary, pending["until"])
        return self._after_pending(summary, pending, done)

    @staticmethod
    def _after_result(summary: dict, done: int | None) -> dict | None:
        if done is None:
            return summary["free"]
        k = bisect_right(summary["upto"], done)
        if k < len(summary["ends"]):
            return summary["ends"][k]
        return {"done": done} if summary["whole"] else None

    def _after_pending(self, summary: dict, pending: dict, done: int | None) -> dict | None:
        until = pending["until"]
        if done is None:
            found = summary["decided"]
        else:
            found = next((way for upto, way in summary["intents"] if done < upto), None)
            answer = summary["answer"]
            if found is None and answer is not None:
                if until <= answer["at"]:
                    return self._after_result(summary, until)
                if answer["approve"] and answer["at"] - done <= self.machine.dedup_us:
                    return self._after_result(summary, done)
                return answer["end"]
            found = found or {"at": None, "done": done}
        if found is None:
            return None
        if until <= (summary["last"] if found["at"] is None else found["at"]):
            return self._after_result(summary, until)
        return {"pending": pending, "done": found["done"]} if found["at"] is None else found["end"]


def action_events(intents: DataFrame, approvals: DataFrame, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Intents and well-formed approvals in one narrow layout for the state machine."""
    keep = ["action_id", "event_type", "status", *_INTENT, "_at", seq]

    def shaped(df: DataFrame, event_type: str) -> DataFrame:
        df = df.withColumn("_at", micros(ts)).withColumn("event_type", F.lit(event_type))
        return df.select(*[c if c in df.columns else F.lit(None).cast("string").alias(c) for c in keep])

    none = F.lit(None).cast("string")
    first = shaped(intents, "ACTION_INTENT").filter(F.coalesce("action_id", F.lit("")) != "")
    decided = normalize_decisions(approvals)
    second = decided.select(
        "action_id",
        F.lit("ACTION_APPROVAL").alias("event_type"),
        none.alias("status"),
        *[none.alias(c) for c in _INTENT],
        micros(ts).alias("_at"),
        seq,
        "decision",
        "approver",
    )
    return first.withColumn("decision", none).withColumn("approver", none).unionByName(second)


def resolve_approvals(
    intents: DataFrame,
    approvals: DataFrame,
    require_approval: bool = True,
    pending_ttl: int = 900,
    dedup_ttl: int = 600,
    as_of: Column | str | int | None = None,
    ts: str = "ts",
    seq: str = "seq",
    blocks: int | None = None,
) -> DataFrame:
    """ACTION_RESULT records of a replay, folded per action id in event-time order.

    Actions still pending at the end expire only when ``as_of`` (epoch seconds) is at or past their time.
    """
    end = None if as_of is None else int(as_of) * SECOND
    machine = ApprovalMachine(require_approval, pending_ttl, dedup_ttl, end)
    events = action_events(intents, approvals, ts, seq)
    out = block_fold(
        events, ["action_id"], ["_at", seq], machine.step, machine.finish, RESULT_SCHEMA, blocks=blocks, transition=ApprovalTransition(machine)
    )
    return to_results(out, pending_ttl)
