"""Costly steps run once, and streams hold no more state than their tasks need."""

import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.conftest import at, iso
from tidewatch.operators import bursts
from tidewatch.operators.approvals import ApprovalMachine
from tidewatch.plans import registered
from tidewatch.sources.logstore import log_lines, select_logs
from tidewatch.streaming.operators import rolling_stats_stream
from tidewatch.streaming.processors import FoldProcessor


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    yield 50
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_streams_have_state_for_their_tasks_only(spark, tmp_path, many_partitions):
    path, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    spark.range(20).select(
        F.lit(iso(0)).alias("timestamp"), F.concat(F.lit("s"), F.col("id") % 3).alias("service"), *[F.col("id").cast("double").alias(c) for c in ("cpu_percent", "memory_percent", "network_latency_ms")],
        F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").alias("seq"),
    ).write.parquet(path)
    raw = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    registered._run(rolling_stats_stream(raw), out, checkpoint)
    assert spark.read.parquet(out).count() == 20
    states = [p for p in os.listdir(f"{checkpoint}/state/0") if p.isdigit()]
    assert len(states) == 2 * spark.sparkContext.defaultParallelism < many_partitions
    assert spark.conf.get("spark.sql.shuffle.partitions") == "50"


class Saved:
    """A state and its timers that tell which calls were made."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), []

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.calls.append("clear")
        self.value = None

    def listTimers(self):  # noqa: N802
        self.calls.append("list")
        return iter(sorted(self.timers))

    def registerTimer(self, t):  # noqa: N802
        self.calls.append("register")
        self.timers.add(t)

    def deleteTimer(self, t):  # noqa: N802
        self.calls.append("delete")
        self.timers.discard(t)


class Expired:
    def __init__(self, ms):
        self.ms = ms

    def getExpiryTimeInMs(self):  # noqa: N802
        return self.ms


def test_a_key_costs_few_calls_on_its_state():
    inputs = ["action_id", "event_type", "status", "decision", "_at", "seq"]
    machine, saved = ApprovalMachine(True, 900, 600), Saved()
    fold = FoldProcessor(machine.step, inputs, ["action_id", "status", "_at"], wake=machine.wake, expire=machine.expire)
    fold.init(saved)

    def come(*rows):
        saved.calls.clear()
        return [tuple(r) for r in fold.handleInputRows(("a",), iter([Row(*inputs)(*r) for r in rows]), None)]

    second = 1_000_000
    assert come(("a", "ACTION_INTENT", "PROPOSED", None, 0, None)) == [("a", "PENDING_APPROVAL", 0)]
    assert saved.calls == ["get", "update", "register"] and saved.timers == {900_000}
    assert come(("a", "ACTION_APPROVAL", None, "DENY", 70 * second, 3), ("a", "ACTION_INTENT", "PROPOSED", None, 60 * second, 2)) == [
        ("a", "PENDING_APPROVAL", 60 * second),
        ("a", "DENIED", 70 * second),
    ]
    assert saved.calls == ["get", "delete", "update", "register"] and saved.timers == {670_001}
    assert come(("a", "ACTION_INTENT", "PROPOSED", None, 100 * second, 4)) == []
    assert saved.calls == ["get", "update"] and saved.timers == {670_001}
    assert list(fold.handleExpiredTimer(("a",), None, Expired(670_001))) == []
    assert saved.value is None and not saved.timers
    assert come(("a", "ACTION_INTENT", "PROPOSED", None, 2000 * second, 5)) == [("a", "PENDING_APPROVAL", 2000 * second)]
    assert [tuple(r) for r in fold.handleExpiredTimer(("a",), None, Expired(2_900_000))] == [("a", "EXPIRED", 2900 * second)]
    assert saved.timers == {3_500_001}


def test_a_filter_on_fields_parses_a_line_once(spark):
    rows = [(iso(i), "a", f"m{i}", ("X", "Y", None)[i % 3], at(i), i) for i in range(9)]
    logs = spark.createDataFrame(rows, "timestamp string, service string, message string, kind string, ts timestamp, seq bigint")
    lines = log_lines({"one": logs, "two": logs.filter("seq > 3")})
    found = select_logs(lines, json_fields={"what": "$.kind", "said": "$.message"}, where="what = 'X'", source="ops")
    got = sorted(tuple(r) for r in found.select("topic", "seq", "what", "said").collect())
    assert got == [("one", i, "X", f"m{i}") for i in (0, 3, 6)] + [("two", 6, "X", "m6")]
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson(") + plan.count("parse_json(") == 1, plan


def _counted(spark, df):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def mark(x):
        seen.add(1)
        return x

    return df.withColumn("seq", mark.asNondeterministic()("seq")), seen


def test_a_stream_of_ranges_computes_its_table_once(spark):
    df, seen = _counted(spark, spark.range(100).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("name")))
    stream = registered._in_order(spark, df, "once", end=spark.range(1).select(F.lit(10**6).cast("bigint").alias("seq"), F.lit("end").alias("name")))
    assert stream.isStreaming and seen.value == 100


def test_error_lines_of_the_stream_are_computed_once(spark, monkeypatch):
    lines = spark.range(50).select(F.timestamp_seconds(F.col("id") * 9).alias("ts"), F.col("id").alias("seq"), F.lit("ops").alias("source"), F.lit("error").alias("severity"))
    df, seen = _counted(spark, lines)
    monkeypatch.setattr(registered, "store", lambda spark, sf: df)
    out = registered.stream_error_count(spark, "")
    assert sum(r["count"] for r in out.collect()) == 50 and seen.value == 50


def test_candidates_of_bursts_are_numbered_once(spark, monkeypatch):
    seen = []
    choose = bursts.greedy_spacing

    def spy(df, *args, **kwargs):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return choose(df, *args, **kwargs)

    monkeypatch.setattr(bursts, "greedy_spacing", spy)
    logs = spark.createDataFrame([("a", "error", at(i), i) for i in range(40)], "service string, severity string, ts timestamp, seq bigint")
    fires = bursts.burst_fires(logs, 30, 5)
    assert sorted(r["seq"] for r in fires.collect()) == list(range(4, 40, 5))
    assert len(seen) == 1 and "MapInArrow" not in seen[0]
