"""Following an incident through its intents and results, matching by fallback keys, completeness checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import micros
from tidewatch.operators.approvals import TERMINAL
from tidewatch.operators.joins import hot_values, look_up


# Columns of one (incident, action).
LIFECYCLE = (
    "incident_id", "service", "incident_type", "incident_at", "action_id", "rule_id", "action_type",
    "target_service", "intent_at", "pending_at", "terminal_at", "terminal_status", "sec_to_intent",
    "sec_to_terminal",
)


def waiting_times(df: DataFrame) -> DataFrame:
    """Adds the seconds from incident to intent and from intent to the final result."""

    def seconds(later: str, earlier: str):
        return (micros(later) - micros(earlier)) / 1e6

    return df.withColumns({"sec_to_intent": seconds("intent_at", "incident_at"), "sec_to_terminal": seconds("terminal_at", "intent_at")})


def lifecycle(
    incidents: DataFrame, intents: DataFrame, results: DataFrame, ts: str = "ts", result_ts: str = "result_at"
) -> DataFrame:
    """One row per (incident, action): when intended, when pending, final status, and the waiting times.

    Incidents without intent and actions without result are kept. Repeated records are first reduced to
    the earliest incident per incident id and the earliest intent per action id, so a record sent many times neither
    multiplies the result nor piles up in one join partition.
    """
    status = F.col("status")
    at = F.col(result_ts)
    final = status.isin(*TERMINAL)
    outcome = results.groupBy("action_id").agg(
        F.min(F.when(status == "PENDING_APPROVAL", at)).alias("pending_at"),
        F.min(F.when(final, at)).alias("terminal_at"),
        F.min_by(F.when(final, status), F.when(final, at)).alias("terminal_status"),
    )

    def earliest(df: DataFrame, key: str, name: str, columns: Sequence[str]) -> DataFrame:
        packed = df.groupBy(key).agg(F.min(F.struct(F.col(ts).alias(name), *columns)).alias("_first"))
        return packed.select(key, "_first.*")

    acted = earliest(intents, "action_id", "intent_at", ["incident_id", "rule_id", "action_type", "target_service"])
    opened = earliest(incidents, "incident_id", "incident_at", ["service", "incident_type"])
    # Results meet their intents first: incidents without an action would all carry the same null key.
    handled = acted.join(outcome, "action_id", "left")
    out = opened.join(handled, "incident_id", "left")

    return waiting_times(out).select(*LIFECYCLE)


def match_by_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], left_id: str, value: str, name: str = "matched"
) -> DataFrame:
    """Match each left row to ``value`` of the right table by the first key pair that hits.

    ``keys`` are (left column, right column) pairs in order of preference; ``matched_by`` is the position
    of the winning pair, from 1, and null where nothing matched. A right key that occurs more than once gives its
    smallest ``value``. Each pair is one equality join, never an OR condition; values that many left rows share meet the right
    table by broadcast, and null keys take part in no match (see ``joins.look_up``).
    """
    out = left
    found: list[tuple[int, str]] = []
    texts = [F.col(lk).cast("string") for lk, _ in keys]
    hot = hot_values(left, texts)
    for i, (lk, rk) in enumerate(keys, start=1):
        hit = f"_hit{i}"
        table = (
            right.filter(F.col(rk).isNotNull())
            .groupBy(F.col(rk).cast("string").alias("_key"))
            .agg(F.min(value).alias(hit))
        )
        out = look_up(out, F.col(lk), table, hot.filter(F.col("place") == i - 1), F.col(left_id))
        found.append((i, hit))
    which = None
    for i, hit in found:
        which = (F if which is None else which).when(F.col(hit).isNotNull(), F.lit(i))
    return (
        out.withColumn(name, F.coalesce(*[F.col(h) for _, h in found]))
        .withColumn("matched_by", which)
        .drop(*[h for _, h in found])
    )


def missing(required: DataFrame, seen: DataFrame, on: str) -> DataFrame:
    """Required values that do not occur in ``seen``."""
    return required.join(seen.select(on).distinct(), on, "left_anti")
