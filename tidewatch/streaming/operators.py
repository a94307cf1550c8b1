"""Streaming forms of the stateful operators. On in-order input they give the rows of the batch forms.

Event time decides, and rows behind the watermark are dropped by Spark. Keyed state needs the RocksDB
state store (``session.ROCKSDB_PROVIDER``).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalars import canonical_json, iso_z, micros
from tidewatch.operators.approvals import RESULT_SCHEMA, ApprovalMachine, action_events, to_results
from tidewatch.operators.bursts import error_logs
from tidewatch.operators.logs import log_json
from tidewatch.operators.metrics import VALUES, finish_metrics, prepare_metrics
from tidewatch.operators.remediation import DEDUP_TTL, remediation_step
from tidewatch.streaming.processors import FoldProcessor, burst_step, rolling_step


def _plain(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])


def _keyed(df: DataFrame, keys: list[str], processor: FoldProcessor, schema: T.StructType, timers: bool = False) -> DataFrame:
    return df.groupBy(*keys).transformWithState(
        processor, schema, "append", "eventTime" if timers else "none"
    )


def rolling_stats_stream(df: DataFrame, n: int = 5, by: str = "service", ts: str = "ts") -> DataFrame:
    """Raw metrics to enriched metrics with one window per ``by`` value.

    For one window over everything, or for values too busy for one task, use ``sinks.rolling_sink``.
    """
    ready = prepare_metrics(df).withColumn("_at", micros(ts)).drop(ts)
    added = [T.StructField(f"{short}_avg_{n}", T.DoubleType()) for short in VALUES.values()]
    schema = T.StructType([*_plain(ready).fields, *added])
    step = partial(rolling_step, n=n, values=dict(VALUES))
    out = _keyed(ready, [by], FoldProcessor(step, ready.columns, schema.names), schema)
    return finish_metrics(out.withColumn(ts, F.timestamp_micros("_at")).drop("_at"))


def detect_bursts_stream(
    df: DataFrame, window_sec: int = 30, threshold: int = 8, ts: str = "ts", seq: str = "seq"
) -> DataFrame:
    """ERROR_RATE_SPIKE incidents of a stream of parsed logs. Only error logs reach the state."""
    details = canonical_json(
        {
            "window_sec": F.lit(window_sec),
            "count": F.lit(threshold),
            "threshold": F.lit(threshold),
            "sample_log": log_json(),
        },
        raw=("sample_log",),
    )
    slim = error_logs(df).select(
        "service",
        micros(ts).alias("_at"),
        seq,
        F.coalesce(F.nullif("timestamp", F.lit("")), iso_z(ts)).alias("timestamp"),
        details.alias("details"),
    )
    step = partial(burst_step, window_sec=window_sec, threshold=threshold)
    out = _keyed(slim, ["service"], FoldProcessor(step, slim.columns, slim.columns, ("_at", seq)), _plain(slim))
    return out.select(
        "timestamp",
        "service",
        F.lit("critical").alias("severity"),
        F.lit("ERROR_RATE_SPIKE").alias("incident_type"),
        F.lit("logs_parsed").alias("source"),
        "details",
        F.timestamp_micros("_at").alias(ts),
        seq,
    )


def apply_cooldown_stream(candidates: DataFrame, ttl: int = DEDUP_TTL, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Candidates outside the cooldown of (rule, target) and not repeated within the TTL.

    The state of a (rule, target) holds the end of its cooldown and the ids emitted within one TTL.
    """
    placed = candidates.withColumn("_at", micros(ts)).drop(ts)
    step = partial(remediation_step, ttl=ttl)
    processor = FoldProcessor(step, placed.columns, placed.columns, ("_at", seq, "rule_order"))
    out = _keyed(placed, ["rule_id", "target_service"], processor, _plain(placed))
    return out.withColumn(ts, F.timestamp_micros("_at")).select(*candidates.columns)


def resolve_approvals_stream(
    intents: DataFrame,
    approvals: DataFrame,
    require_approval: bool = True,
    pending_ttl: int = 900,
    dedup_ttl: int = 600,
    delay: str = "0 seconds",
    ts: str = "ts",
    seq: str = "seq",
) -> DataFrame:
    """ACTION_RESULT records of intent and approval streams.

    A pending action expires when the watermark passes its time; the state of an action is dropped
    once its result is older than the deduplication TTL.
    """
    machine = ApprovalMachine(require_approval, pending_ttl, dedup_ttl)
    events = action_events(intents, approvals, ts, seq)
    timed = events.withColumn("_ts", F.timestamp_micros("_at")).withWatermark("_ts", delay)
    processor = FoldProcessor(
        machine.step, timed.columns, RESULT_SCHEMA.names, ("_at", seq), wake=machine.wake, expire=machine.expire
    )
    out = _keyed(timed, ["action_id"], processor, RESULT_SCHEMA, timers=True)
    return to_results(out, pending_ttl)

