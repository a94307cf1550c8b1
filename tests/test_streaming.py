"""Streaming operators give the batch result on in-order input, also across a restart."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, iso
from tidewatch.operators.approvals import resolve_approvals
from tidewatch.operators import timeline
from tidewatch.operators.bursts import detect_bursts
from tidewatch.operators.lifecycle import LIFECYCLE, lifecycle
from tidewatch.operators.metrics import enrich_metrics
from tidewatch.operators.remediation import apply_cooldown
from tidewatch.schemas import LOGS_RAW, METRICS_RAW
from tidewatch.sources.logstore import normalize_log_lines
from tidewatch.sources.topics import read_topic
from tidewatch.streaming import operators as O
from tidewatch.streaming import counts, sinks
from tidewatch.streaming.lifecycle import lifecycle_stream

CLOCK = ", seq bigint"


class Folder:
    """JSON files that arrive one after the other."""

    def __init__(self, root):
        self.path = root / "in"
        self.path.mkdir()
        self.files = 0

    def add(self, spark, rows, schema):
        body = "\n".join(spark.createDataFrame(rows, schema).toJSON().collect())
        file = self.path / f"part-{self.files:04d}.json"
        file.write_text(body + "\n")
        os.utime(file, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def read(self, spark, schema, one_by_one=True):
        reader = spark.readStream.schema(schema)
        if one_by_one:
            reader = reader.option("maxFilesPerTrigger", 1)
        return reader.json(str(self.path))


def timed(df):
    return df.withColumn("ts", F.to_timestamp("timestamp"))


def run_to_parquet(df, out, checkpoint):
    query = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    query = query.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def chunks(rows, n=60):
    return [rows[i : i + n] for i in range(0, len(rows), n)]


def metric_rows(n=200):
    rng = random.Random(1)
    return [(iso(i), rng.choice("ab"), None, rng.random() * 100, rng.random() * 100, 1, rng.random() * 300, 1, 0.0, i) for i in range(n)]


def plain(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_rolling_by_service_with_restart(spark, tmp_path):
    rows, folder = metric_rows(), Folder(tmp_path)
    schema = METRICS_RAW + CLOCK
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    parts = chunks(rows)
    for stage in (parts[:2], parts[2:]):
        for part in stage:
            folder.add(spark, part, schema)
        run_to_parquet(O.rolling_stats_stream(timed(folder.read(spark, schema))), out, checkpoint)
    columns = ("seq", "service", "severity", "cpu_avg_5", "memory_avg_5", "latency_avg_5", "cpu_to_memory_ratio")
    want = enrich_metrics(timed(spark.createDataFrame(rows, schema)), by="service")
    assert plain(spark.read.parquet(out), *columns) == plain(want, *columns)


@pytest.mark.parametrize("by", [None, "service"])
def test_rolling_sink_with_restart(spark, tmp_path, by):
    rows, folder = metric_rows(), Folder(tmp_path)
    schema = METRICS_RAW + CLOCK
    out, carry, checkpoint = (str(tmp_path / x) for x in ("out", "carry", "cp"))
    parts = chunks(rows)
    for stage in (parts[:2], parts[2:]):
        for part in stage:
            folder.add(spark, part, schema)
        sinks.rolling_sink(timed(folder.read(spark, schema)), out, carry, checkpoint, by=by).awaitTermination()
    columns = ("seq", "service", "severity", "cpu_avg_5", "memory_avg_5", "latency_avg_5")
    want = enrich_metrics(timed(spark.createDataFrame(rows, schema)), by=by)
    assert plain(spark.read.parquet(out), *columns) == plain(want, *columns)


def test_bursts(spark, tmp_path):
    rng, folder = random.Random(4), Folder(tmp_path)
    schema = "timestamp string, service string, message string, severity string, trace_id string, original_level string" + CLOCK
    rows = [(iso(i), rng.choice(["a", "a", "b", ""]), f"m{i}", rng.choice(["error", "Critical", "info"]), "t", "L", i) for i in range(240)]
    for part in chunks(rows):
        folder.add(spark, part, schema)
    out = str(tmp_path / "out")
    stream = O.detect_bursts_stream(timed(folder.read(spark, schema)), 30, 5)
    run_to_parquet(stream, out, str(tmp_path / "cp"))
    want = detect_bursts(timed(spark.createDataFrame(rows, schema)), 30, 5)
    columns = ("timestamp", "service", "severity", "incident_type", "details", "seq")
    assert plain(spark.read.parquet(out), *columns) == plain(want, *columns) != []


@pytest.mark.parametrize("threshold", [2, 5])
def test_burst_sink_with_restart(spark, tmp_path, threshold):
    rng, folder = random.Random(7), Folder(tmp_path)
    schema = "timestamp string, service string, message string, severity string, trace_id string, original_level string" + CLOCK
    rows = [(iso(i * 2), rng.choice("aab"), f"m{i}", rng.choice(["error", "info"]), "t", "L", i) for i in range(200)]
    out, carry, checkpoint = (str(tmp_path / x) for x in ("out", "carry", "cp"))
    parts = chunks(rows, 50)
    for stage in (parts[:2], parts[2:]):
        for part in stage:
            folder.add(spark, part, schema)
        sinks.burst_sink(timed(folder.read(spark, schema)), out, carry, checkpoint, 30, threshold).awaitTermination()
    want = detect_bursts(timed(spark.createDataFrame(rows, schema)), 30, threshold)
    columns = ("timestamp", "service", "incident_type", "details", "seq")
    assert plain(spark.read.parquet(out), *columns) == plain(want, *columns) != []


COOLDOWN = "timestamp string, rule_id string, target_service string, cooldown_sec int, action_id string, rule_order int" + CLOCK


def cooldown_rows():
    rng, rows = random.Random(5), []
    for i in range(200):
        rule, target = rng.choice(["r1", "r2"]), rng.choice("xy")
        rows.append((iso(i * 20), rule, target, 120 if rule == "r1" else 0, f"{rule}{target}{rng.randrange(9)}", 0, i))
    return rows


def test_cooldown_sink_with_restart(spark, tmp_path):
    rows, folder = cooldown_rows(), Folder(tmp_path)
    out, carry, checkpoint = (str(tmp_path / x) for x in ("out", "carry", "cp"))
    parts = chunks(rows)
    for stage in (parts[:2], parts[2:]):
        for part in stage:
            folder.add(spark, part, COOLDOWN)
        sinks.cooldown_sink(timed(folder.read(spark, COOLDOWN)), out, carry, checkpoint).awaitTermination()
    want = apply_cooldown(timed(spark.createDataFrame(rows, COOLDOWN)))
    assert plain(spark.read.parquet(out), "seq", "action_id") == plain(want, "seq", "action_id")


def test_cooldown(spark, tmp_path):
    rows, folder = cooldown_rows(), Folder(tmp_path)
    for part in chunks(rows):
        folder.add(spark, part, COOLDOWN)
    out = str(tmp_path / "out")
    run_to_parquet(O.apply_cooldown_stream(timed(folder.read(spark, COOLDOWN))), out, str(tmp_path / "cp"))
    want = apply_cooldown(timed(spark.createDataFrame(rows, COOLDOWN)))
    assert plain(spark.read.parquet(out), "seq", "action_id") == plain(want, "seq", "action_id")


def test_approvals_with_expiry(spark, tmp_path):
    folder = Folder(tmp_path)
    schema = "timestamp string, event_type string, action_id string, status string, action_type string, target_service string, incident_id string, decision string, approver string, seq bigint"

    def intent(i, sec, action):
        return (iso(sec), "ACTION_INTENT", action, "PROPOSED", "SCALE_UP", "payments", "inc", None, None, i)

    def approval(i, sec, action, said):
        return (iso(sec), "ACTION_APPROVAL", action, None, None, None, None, said, "op", i)

    parts = [
        [intent(0, 0, "a"), intent(1, 1, "b"), intent(2, 2, "c")],
        [approval(3, 60, "a", "yes"), approval(4, 70, "b", "no"), intent(5, 80, "a")],
        [intent(6, 700, "a"), intent(7, 750, "d")],
        [approval(8, 1000, "c", "yes"), approval(9, 1100, "d", "Approve")],
        [intent(10, 5000, "e")],
        [intent(11, 9000, "f")],
    ]
    for part in parts:
        folder.add(spark, part, schema)
    stream = timed(folder.read(spark, schema))
    kind = F.col("event_type")
    intents, approvals = stream.filter(kind == "ACTION_INTENT"), stream.filter(kind == "ACTION_APPROVAL")
    out = str(tmp_path / "out")
    run_to_parquet(O.resolve_approvals_stream(intents, approvals), out, str(tmp_path / "cp"))
    rows = timed(spark.createDataFrame([r for p in parts for r in p], schema))
    want = resolve_approvals(rows.filter(kind == "ACTION_INTENT"), rows.filter(kind == "ACTION_APPROVAL"), as_of=int(at(9000).timestamp()) - 1)
    columns = ("action_id", "status", "message", "ts", F.coalesce("approver", F.lit("")))
    got = plain(spark.read.parquet(out), *columns)
    assert got == plain(want, *columns)
    assert {(r[0], r[1]) for r in got} >= {("a", "EXECUTED"), ("b", "DENIED"), ("c", "EXPIRED"), ("d", "EXECUTED"), ("e", "EXPIRED")}


def test_topic_stream_and_log_store(spark, tmp_path):
    source, target, store = tmp_path / "in", str(tmp_path / "topic"), str(tmp_path / "store")
    source.mkdir()
    cp = [str(tmp_path / f"cp{i}") for i in range(2)]
    for i in range(2):
        (source / f"{i}.json").write_text(f'{{"timestamp":"{iso(i)}","service":"s{i}","message":"m{i}"}}\n')
        stream = read_topic(spark, "logs_raw", path=str(source), stream=True).drop("_malformed")
        sinks.write_topic_stream(stream, "logs_raw", cp[0], path=target).awaitTermination()
        lines = normalize_log_lines(read_topic(spark, "logs_raw", path=str(source), stream=True).drop("_malformed"), "logs_raw")
        sinks.write_log_store_stream(lines, store, cp[1]).awaitTermination()
    back = read_topic(spark, "logs_raw", path=target)
    assert plain(back, "service", "message") == [("s0", "m0"), ("s1", "m1")]
    kept = spark.read.parquet(store)
    assert plain(kept, "service", "severity", "message") == [("s0", "info", "m0"), ("s1", "info", "m1")]


def test_quarantine(spark, tmp_path):
    source, dead, good = tmp_path / "in", str(tmp_path / "dead"), str(tmp_path / "good")
    source.mkdir()
    (source / "0.json").write_text('{"service":"a"}\n{bad\n\n')
    stream = read_topic(spark, "logs_raw", LOGS_RAW, path=str(source), stream=True)

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{good}/batch={batch_id}")

    sinks.quarantine(stream, keep, dead, str(tmp_path / "cp")).awaitTermination()
    assert [r.value for r in spark.read.text(dead).collect()] == ["{bad"]
    assert sorted(str(r.service) for r in spark.read.parquet(good).collect()) == ["None", "a"]


def test_latest_skips_what_is_there(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "topic")
    source.mkdir()
    (source / "old.json").write_text('{"service":"old"}\n')
    checkpoint = str(tmp_path / "cp")

    def stream():
        return read_topic(spark, "logs_raw", path=str(source), start="latest", stream=True, checkpoint=checkpoint).drop("_malformed")

    first = stream()
    (source / "new.json").write_text('{"service":"new"}\n')
    later = os.stat(source / "old.json").st_mtime + 10
    os.utime(source / "new.json", (later, later))
    sinks.write_topic_stream(first, "latest", checkpoint, path=target).awaitTermination()
    assert plain(read_topic(spark, "logs_raw", path=target), "service") == [("new",)]
    # What comes while the query is stopped is delivered when it runs again.
    (source / "between.json").write_text('{"service":"between"}\n')
    os.utime(source / "between.json", (later + 10, later + 10))
    sinks.write_topic_stream(stream(), "latest", checkpoint, path=target).awaitTermination()
    assert sorted(plain(read_topic(spark, "logs_raw", path=target), "service")) == [("between",), ("new",)]
    with pytest.raises(ValueError):
        read_topic(spark, "logs_raw", path=str(source), start="latest", stream=True)


STREAMS = {
    "incidents": "incident_id string, service string, incident_type string, ts timestamp",
    "intents": "action_id string, incident_id string, rule_id string, action_type string, target_service string, ts timestamp",
    "results": "action_id string, status string, result_at timestamp",
}


def lifecycle_rows(n, seed):
    """(incidents, intents, results) in order of time, several intents for some incidents, some records twice."""
    rng = random.Random(seed)
    incidents = [(f"i{k}", rng.choice("ab"), "T", at(100 + 10 * k)) for k in range(n)]
    intents, results = [], []
    for k in range(n):
        for rule in ("r1", "r2")[: rng.randrange(3)]:
            begin = 100 + 10 * k + rng.randrange(60)
            action = f"{rule}-{k}"
            intents.append((action, f"i{k}", rule, "SCALE_UP", "t", at(begin)))
            if rng.random() < 0.8:
                results.append((action, "PENDING_APPROVAL", at(begin)))
            if rng.random() < 0.7:
                results.append((action, rng.choice(["EXECUTED", "DENIED", "EXPIRED", "FAILED"]), at(begin + rng.randrange(1, 300))))
    out = {"incidents": incidents, "intents": sorted(intents, key=lambda r: r[-1]), "results": sorted(results, key=lambda r: r[-1])}
    return {name: [r for row in rows for r in [row] * (1 + (rng.random() < 0.1))] for name, rows in out.items()}


def run_lifecycle(spark, root, horizon="20 minutes"):
    def read(name):
        return spark.readStream.schema(STREAMS[name]).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")

    stream = lifecycle_stream(read("incidents"), read("intents"), read("results"), horizon, "30 seconds")
    run_to_parquet(stream, f"{root}/out", f"{root}/cp")
    return sorted(tuple(map(str, r)) for r in spark.read.parquet(f"{root}/out").filter("incident_id NOT LIKE 'end%'").collect())


def add_rows(spark, root, name, rows):
    path = f"{root}/{name}"
    spark.createDataFrame(rows, STREAMS[name]).coalesce(1).write.mode("append").parquet(path)


def add_end(spark, root, n):
    later = at(10**6 * n)
    add_rows(spark, root, "incidents", [(f"end{n}", "", "", later)])
    add_rows(spark, root, "intents", [(f"end{n}", f"end{n}", "", "", "", later)])
    add_rows(spark, root, "results", [(f"end{n}", "EXECUTED", later)])


def test_lifecycle_stream_with_restart_and_late_rows(spark, tmp_path):
    root, rows = str(tmp_path), lifecycle_rows(90, 3)
    early = []
    for half in (0, 1):
        for part in (2 * half, 2 * half + 1):
            for name, found in rows.items():
                size = -(-len(found) // 4)
                add_rows(spark, root, name, found[part * size : (part + 1) * size])
        early.append(run_lifecycle(spark, root))
    # Long behind the streams, and behind what they still may bring.
    add_end(spark, root, 1)
    run_lifecycle(spark, root)
    add_rows(spark, root, "incidents", [("late", "a", "T", at(5))])
    add_rows(spark, root, "intents", [("late", "i3", "r9", "SCALE_UP", "t", at(6))])
    add_rows(spark, root, "results", [("r1-3", "EXECUTED", at(7))])
    add_end(spark, root, 2)
    got = run_lifecycle(spark, root)
    want = lifecycle(*[spark.createDataFrame(found, STREAMS[name]) for name, found in rows.items()]).select(*LIFECYCLE)
    assert got == sorted(tuple(map(str, r)) for r in want.collect())
    assert 0 < len(early[0]) < len(early[1]) < len(got)
    assert any(r[11] == "None" and r[4] != "None" for r in got) and any(r[4] == "None" for r in got)


def test_lifecycle_stream_of_rows_beyond_the_horizon(spark, tmp_path):
    root = str(tmp_path)
    add_rows(spark, root, "incidents", [("i1", "a", "T", at(0 + 100)), ("i2", "a", "T", at(100))])
    add_rows(spark, root, "intents", [("a1", "i1", "r", "SCALE_UP", "t", at(100 + 1200)), ("a2", "i2", "r", "SCALE_UP", "t", at(100 + 1201))])
    add_rows(spark, root, "results", [("a1", "EXECUTED", at(100 + 1200 + 1201)), ("none", "EXECUTED", at(90))])
    add_end(spark, root, 1)
    got = [(r[0], r[4], r[11]) for r in run_lifecycle(spark, root)]
    assert got == [("i1", "a1", "None"), ("i2", "None", "None")]


def test_counts_are_kept_up_to_date(spark, tmp_path):
    """Several batches, a restart, late rows and a batch that runs twice give the counts of all rows."""
    rng, folder = random.Random(8), Folder(tmp_path)
    schema = "sec double, service string, severity string"
    rows = [(float(rng.randrange(100_000, 190_000)), rng.choice("ab"), rng.choice(["error", "info"])) for _ in range(600)] + [(None, "a", "error")]
    table, checkpoint = str(tmp_path / "counts"), str(tmp_path / "cp")
    parts = chunks(rows, 150)

    def placed(df):
        return df.withColumn("ts", (F.lit(at(0).timestamp()) + F.col("sec")).cast("timestamp"))

    for stage in (parts[:2], parts[2:]):
        for part in stage:
            folder.add(spark, part, schema)
        counts.count_sink(placed(folder.read(spark, schema)), table, checkpoint, 60, ["service", "severity"]).awaitTermination()
    batch = placed(spark.createDataFrame(parts[1], schema))
    counts.write_batch_counts(batch, 1, table, 60, ["service", "severity"])
    whole = placed(spark.createDataFrame(rows, schema))
    kept = counts.read_counts(spark, table, ["service", "severity"])
    for by, span, step in ((["service"], 300, 60), ([], 3600, 600), (["severity", "service"], 60, 120)):
        got = timeline.count_over_buckets(kept, 60, span, step, by)
        assert plain(got, "eval_at", *by, "count") == plain(timeline.count_over_time(whole.filter("ts IS NOT NULL"), span, step, by), "eval_at", *by, "count") != []
    want = plain(timeline.count_over_time(whole.filter("ts IS NOT NULL"), 300, 60, ["service"]), "eval_at", "service", "count")
    for _ in range(2):
        counts.merge_counts(spark, table, ["service", "severity"])
        assert [p for p in os.listdir(table) if not p.startswith((".", "_"))] == ["base=4"]
    # A replaced batch that runs again is not read, a new one is.
    counts.write_batch_counts(batch, 1, table, 60, ["service", "severity"])
    kept = counts.read_counts(spark, table, ["service", "severity"])
    assert plain(timeline.count_over_buckets(kept, 60, 300, 60, ["service"]), "eval_at", "service", "count") == want
    counts.write_batch_counts(batch, 5, table, 60, ["service", "severity"])
    assert counts.read_counts(spark, table, ["service", "severity"]).agg(F.sum("n")).first()[0] == 600 + len(parts[1])
    counts.merge_counts(spark, table, ["service", "severity"])
    assert counts.read_counts(spark, table, ["service", "severity"]).agg(F.sum("n")).first()[0] == 600 + len(parts[1])
    counts.write_batch_counts(whole.filter("false"), 5, table, 60, ["service", "severity"])
    start, end = F.lit(at(150_000)), F.lit(at(172_000))
    some = counts.read_counts(spark, table, ["service", "severity"], start, end)
    inside = [149_940 < s and -(-s // 60) * 60 <= 172_000 for s, _, _ in [*rows, *parts[1]] if s is not None]
    assert some.agg(F.sum("n")).first()[0] == sum(inside)
    assert counts.read_counts(spark, str(tmp_path / "none"), ["service"]).isEmpty()
    assert "dt#" in some._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]
    with pytest.raises(ValueError, match="multiples"):
        timeline.count_over_buckets(kept, 60, 90, 60)
