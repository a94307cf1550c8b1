"""Topics, the log store, dashboard questions and the forest."""

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import at, iso
from tidewatch.operators import timeline as T
from tidewatch.operators.forest import ForestModel, average_path, fit_forest, tree_samples
from tidewatch.schemas import LOGS_RAW
from tidewatch.sources import logstore as S
from tidewatch.sources import topics as K


def test_topic_round_trip_with_empty_and_malformed_lines(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("t1", "s", None, "mé\"ss", "x")], LOGS_RAW)
    K.write_topic(df, "logs_raw", path=path)
    lines = spark.createDataFrame([("",), ("{}",), ("{broken",), ('["list"]',)], "value string")
    lines.write.mode("append").text(path)
    good, bad = K.split_malformed(K.read_topic(spark, "logs_raw", path=path))
    rows = [tuple(r) for r in good.collect()]
    assert ("logs_raw", "t1", "s", None, "mé\"ss", "x") in rows
    assert rows.count(("logs_raw", None, None, None, None, None)) >= 2
    assert {r.value for r in bad.collect()} >= {"{broken"}


def test_null_value_is_an_empty_record(spark):
    df = spark.createDataFrame([(None,), ("",), ('{"service":"a"}',)], "value string")
    out = K.parse_values(df, LOGS_RAW).collect()
    assert [r.service for r in out] == [None, None, "a"] and all(r._malformed is None for r in out)


def test_union_topics(spark):
    a = spark.createDataFrame([(1, "x")], "v int, s string")
    b = spark.createDataFrame([("one", 2.5)], "v string, d double")
    out = K.union_topics({"a": a, "b": b}).orderBy("topic").collect()
    assert [(r.topic, r.v, r.s, r.d) for r in out] == [("a", "1", "x", None), ("b", "one", None, 2.5)]


def test_log_lines(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    logs = spark.createDataFrame([("hello", "", "warn", iso(5)), (None, None, None, None)], "message string, service string, severity string, timestamp string")
    nested = spark.createDataFrame([((1, "x"),)], "message struct<a:int,b:string>")
    plain = spark.createDataFrame([("s", 3)], "service string, n int")
    out = S.log_lines({"logs_parsed": logs, "nested": nested, "plain": plain}, now=now).collect()
    by = {(r.topic, r.timestamp): r for r in out}
    first = by["logs_parsed", iso(5)]
    assert (first.message, first.service, first.severity, first.source) == ("hello", "", "warn", "ops")
    second = by["logs_parsed", "2024-01-02T00:00:00Z"]
    assert (second.service, second.severity) == ("unknown", "info") and json.loads(second.message) == {"topic": "logs_parsed"}
    assert json.loads(by["nested", "2024-01-02T00:00:00Z"].message) == {"a": 1, "b": "x"}
    assert json.loads(by["plain", "2024-01-02T00:00:00Z"].message) == {"service": "s", "n": 3, "topic": "plain"}
    assert json.loads(first.line) == {"message": "hello", "service": "", "severity": "warn", "timestamp": iso(5), "topic": "logs_parsed"}
    assert json.loads(by["nested", "2024-01-02T00:00:00Z"].line) == {"message": {"a": 1, "b": "x"}, "topic": "nested"}
    found = S.select_logs(S.log_lines({"logs_parsed": logs}, now=now), json_fields={"at": "$.timestamp"}, where="at IS NOT NULL")
    assert [r.at for r in found.collect()] == [iso(5)]


def lines(spark, n=3000):
    rng = random.Random(2)
    topics, severities = ["incidents", "logs_parsed"], ["info", "warn", "error"]
    rows = [
        ("ops", rng.choice(topics), rng.choice(["a", "b"]), rng.choice(severities), json.dumps({"k": i, "severity": "zzz"}), iso(i), at(rng.randrange(200_000)), i)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "source string, topic string, service string, severity string, message string, timestamp string, ts timestamp, seq bigint")


def test_store_is_pruned_by_labels(spark, tmp_path):
    path = str(tmp_path / "store")
    df = lines(spark)
    S.write_log_store(df, path)
    back = S.read_log_store(spark, path)
    assert back.count() == 3000
    out = S.select_logs(back, topic="incidents", severity="error", service="a")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "(severity" in plan.split("PushedFilters")[0]
    assert out.count() == S.select_logs(df, topic="incidents", severity="error", service="a").count() > 0
    kept = S.apply_retention(back, "2024-01-02 12:00:00", hours=24)
    assert "PartitionFilters: [isnotnull(dt" in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == df.filter("ts >= '2024-01-01 12:00:00'").count()


def test_json_fields_do_not_replace_labels(spark):
    out = S.select_logs(lines(spark), json_fields={"severity": "$.severity", "k": "$.k"}, where="severity = 'error' AND k < 10")
    assert {r.severity for r in out.collect()} == {"error"}


@pytest.mark.parametrize(("span", "step"), [(60, 60), (300, 60), (60, 300), (50, 30), (45, 60)])
def test_count_over_time_equals_brute_force(spark, span, step):
    rng = random.Random(span + step)
    times = [rng.randrange(2000) + rng.choice([0, 0.5]) for _ in range(400)] + [0, span, 2 * span]
    df = spark.createDataFrame([(at(t), rng.choice("xy")) for t in times], "ts timestamp, service string")
    got = {(r.eval_at.timestamp(), r.service): r["count"] for r in T.count_over_time(df, span, step, ["service"]).collect()}
    rows = [(r.ts.timestamp(), r.service) for r in df.collect()]
    base = int(min(t for t, _ in rows) // step * step)
    want = {}
    for t in range(base, base + 4000, step):
        for s in "xy":
            n = sum(t - span < e <= t and s == x for e, x in rows)
            if n:
                want[float(t), s] = n
    assert got == want


def test_last_value_and_order(spark):
    df = spark.createDataFrame([(at(0), "a", 5), (at(1), "a", None), (at(0), "b", 9)], "eval_at timestamp, s string, count int")
    out = T.sorted_desc(T.last_value(df, "count", ["s"]), "count", ["s"])
    assert [tuple(r) for r in out.collect()] == [("b", 9), ("a", 5)]


def test_tail_and_range(spark):
    df = lines(spark)
    newest = T.tail(df, 5, severity="error").collect()
    want = sorted(((r.ts, r.seq) for r in df.collect() if r.severity == "error"), reverse=True)[:5]
    assert [(r.ts, r.seq) for r in newest] == want
    span = T.query_range(df, "2024-01-01 01:00:00", "2024-01-01 02:00:00", 7, "forward", topic="incidents").collect()
    assert len(span) == 7 and [r.ts for r in span] == sorted(r.ts for r in span)
    plan = T.tail(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_freshness(spark):
    df = spark.createDataFrame([("a", at(0)), ("b", at(1))], "topic string, ts timestamp")
    out = {r.topic: r.fresh for r in T.freshness(df, "2024-01-01 00:10:01").collect()}
    assert out == {"a": False, "b": True}


def test_labels(spark):
    df = lines(spark)
    out = {r.label: (r["values"], r.lines) for r in T.labels(df, S.LABELS).collect()}
    assert out == {"source": (1, 3000), "topic": (2, 3000), "service": (2, 3000), "severity": (3, 3000)}


@pytest.mark.parametrize("by", [[], ["s"], ["t", "s"]])
def test_exact_percentile(spark, by):
    rng = random.Random(8)
    rows = [(rng.choice("aaab"), at(rng.randrange(3) * 60), rng.choice([7.0, rng.random() * 50, None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "s string, t timestamp, v double")
    got = {tuple(r[c] for c in by): r.percentile for r in T.exact_percentile(df, "v", 0.95, by).collect()}
    groups = {}
    for r in df.collect():
        if r.v is not None:
            groups.setdefault(tuple(r[c] for c in by), []).append(r.v)
    assert got.keys() == groups.keys()
    for k, v in groups.items():
        assert got[k] == pytest.approx(np.percentile(v, 95))


def training(spark, n=2000):
    rng = np.random.default_rng(1)
    data = pd.DataFrame({"seq": range(n), "cpu": rng.uniform(10, 70, n), "mem": rng.uniform(20, 80, n), "lat": rng.uniform(5, 150, n)})
    return spark.createDataFrame(data)


def test_forest(spark, tmp_path):
    df = training(spark)
    model = fit_forest(df, ("cpu", "mem", "lat"), n_trees=40)
    again = fit_forest(df.repartition(7), ("cpu", "mem", "lat"), n_trees=40)
    assert model.offset == again.offset
    scored = model.score(df)
    assert scored.filter("is_anomaly").count() / 2000 == pytest.approx(0.05, abs=0.002)
    odd = spark.createDataFrame([(0, 40.0, 50.0, 77.0), (1, 75.0, 85.0, 800.0), (2, None, None, 9e9)], "seq int, cpu double, mem double, lat double")
    flags = [r.is_anomaly for r in model.score(odd).orderBy("seq").collect()]
    assert flags == [False, True, True]
    assert model.nodes.groupby("tree_id").size().max() <= 2 * 256
    assert model.nodes.depth.max() <= 8
    roots = model.nodes[model.nodes.node_id == 0]
    assert (roots["size"] == 256).all() and len(roots) == 40
    model.save(spark, str(tmp_path / "m"))
    loaded = ForestModel.load(spark, str(tmp_path / "m"))
    a = [r.anomaly_score for r in model.score(odd).orderBy("seq").collect()]
    assert a == [r.anomaly_score for r in loaded.score(odd).orderBy("seq").collect()]


def test_every_tree_can_take_its_full_sample(spark):
    df = spark.range(40_000).withColumnRenamed("id", "seq")
    out = tree_samples(df, 40_000, 10, 50, 1, "seq")
    sizes = [r["count"] for r in out.groupBy("tree_id").count().collect()]
    assert len(sizes) == 10 and all(50 <= s <= 250 for s in sizes)
    few = spark.range(30).withColumnRenamed("id", "seq")
    assert {r["count"] for r in tree_samples(few, 30, 10, 30, 1, "seq").groupBy("tree_id").count().collect()} == {30}
    with pytest.raises(ValueError, match="identify"):
        fit_forest(spark.range(40_000).select(F.lit(7).alias("seq"), F.col("id").cast("double").alias("v")), ("v",), n_trees=10)


def test_average_path():
    assert (average_path(0), average_path(1), average_path(2)) == (0.0, 0.0, 1.0)
    assert average_path(256) == pytest.approx(10.244, abs=0.001)


def days_of(spark, path):
    return {str(k): sorted(f.rsplit("/", 1)[1] for f in spark.read.option("basePath", path).parquet(v).inputFiles()) for k, v in S.store_days(spark, path).items()}


def newest(df, n, **labels):
    rows = [r for r in df.collect() if all(r[k] == v for k, v in labels.items())]
    return [r.seq for r in sorted(rows, key=lambda r: (r.ts is not None, r.ts.timestamp() if r.ts else 0, r.seq), reverse=True)[:n]]


def test_tail_opens_the_newest_days_only(spark, tmp_path):
    path = str(tmp_path / "store")
    df = lines(spark)
    S.write_log_store(df, path)
    days = list(S.store_days(spark, path).values())
    assert len(days) == 3
    assert [r.seq for r in S.tail_store(spark, path, 3000).collect()] == newest(df, 3000)
    assert [r.seq for r in S.tail_store(spark, path, 2500, severity="warn").collect()] == newest(df, 2500, severity="warn")
    # A day that is opened can't be read any more.
    for folder in days[1:]:
        for file in spark.read.parquet(folder).inputFiles():
            with open(file.removeprefix("file://"), "wb") as f:
                f.write(b"broken")
    assert [r.seq for r in S.tail_store(spark, path, 5, severity="error").collect()] == newest(df, 5, severity="error")
    with pytest.raises(Exception, match="(?i)parquet|broken|corrupt|footer"):
        S.tail_store(spark, path, 3000).collect()


def test_tail_of_days_with_few_lines_and_lines_without_time(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "source string, topic string, service string, severity string, message string, timestamp string, ts timestamp, seq bigint"
    rows = [("ops", "t/1", "a", "e=x", "m", None, None if i % 7 == 0 else at(86_400 * i), i) for i in range(20)]
    S.write_log_store(spark.createDataFrame(rows, schema), path)
    df = spark.createDataFrame(rows, schema)
    for n in (1, 4, 16, 17, 19, 100):
        got = [r.seq for r in S.tail_store(spark, path, n).collect()]
        assert got == newest(df, n) and len(got) == min(n, 20)
    assert S.tail_store(spark, path, 5, service="none").isEmpty()


def test_retention_rewrites_the_boundary_day_only(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = lines(spark)
    # Folders of the boundary day: only late lines, only early lines, and both.
    extra = spark.createDataFrame(
        [("ops", "all old", "a", "info", "m", None, at(90_000), 9001), ("ops", "all new", "a", "info", "m", None, at(170_000), 9002), ("ops", "no time", "a", "info", "m", None, None, 9003)], rows.schema
    )
    df = rows.unionByName(extra)
    S.write_log_store(df, path)
    before = days_of(spark, path)
    now, cutoff = "2024-01-03 12:00:00", "2024-01-02 12:00:00"
    done = S.retain_log_store(spark, path, now, hours=24)
    assert [str(d) for d in done.days] == ["2024-01-01"]
    assert {p.topic for p in done.dropped} == {"all old"} and {p.topic for p in done.rewritten} == {"incidents", "logs_parsed"} and len(done.rewritten) == 6
    want = sorted(r.seq for r in df.filter(f"ts >= '{cutoff}' OR ts IS NULL").collect())
    back = S.read_log_store(spark, path)
    assert sorted(r.seq for r in back.collect()) == want
    after = days_of(spark, path)
    assert after["2024-01-03"] == before["2024-01-03"] and after["None"] == before["None"]
    kept = back.filter("topic = 'all new'").inputFiles()
    assert "2024-01-01" not in after and len(kept) >= 1
    # Again, nothing changes; later, the day goes as a whole.
    assert S.retain_log_store(spark, path, now, hours=24) == S.Retained((), (), ())
    assert days_of(spark, path) == after
    S.retain_log_store(spark, path, "2024-01-04 00:00:00", hours=24)
    assert sorted(days_of(spark, path)) == ["2024-01-03", "None"]
    assert S.retain_log_store(spark, str(tmp_path / "nothing"), now) == S.Retained((), (), ())


def test_rewritten_store_holds_the_retained_lines(spark, tmp_path):
    path, out = str(tmp_path / "store"), str(tmp_path / "out")
    df = lines(spark)
    S.write_log_store(df, path)
    S.rewrite_log_store(spark, path, out, "2024-01-03 00:00:00", hours=24, files=2)
    back = S.read_log_store(spark, out)
    assert sorted(r.seq for r in back.collect()) == sorted(r.seq for r in df.filter("ts >= '2024-01-02 00:00:00'").collect())
    assert back.columns == S.read_log_store(spark, path).columns


def test_fields_come_from_the_stored_record(spark, tmp_path):
    path = str(tmp_path / "store")
    texts = ['{"a": {"b": [1, "x"]}, "n": 95.5, "t": true, "z": null}', "not json", "", None, '{"a": "é\\"q", "n": 12345678901234567890}', '[1, 2]']
    rows = [("ops", "t", "s", "info", m, iso(i), at(i), i) for i, m in enumerate(texts)]
    df = spark.createDataFrame(rows, lines(spark).schema)
    S.write_log_store(df, path)
    fields = {"a": "$.a", "b": "$.a.b[1]", "n": "$.n", "t": "$.t", "z": "$.z"}
    want = [('{"b":[1,"x"]}', "x", "95.5", "true", None), (None,) * 5, (None,) * 5, (None,) * 5, ('é"q', None, "12345678901234567890", None, None), (None,) * 5]
    for frame in (S.read_log_store(spark, path), df):
        out = S.select_logs(frame, json_fields=fields, source="ops")
        assert [(r.a, r.b, r.n, r.t, r.z) for r in out.orderBy("seq").collect()] == want
        assert "get_json_object" not in out._jdf.queryExecution().executedPlan().toString()


def exact_rank(values, x):
    return sum(v < x for v in values) / len(values), sum(v <= x for v in values) / len(values)


@pytest.mark.parametrize("k", [50, 200])
def test_sketches_keep_their_error_when_merged(spark, k):
    rng = random.Random(k)
    rows = [(at(rng.randrange(7200)), rng.choice("ab"), rng.lognormvariate(3, 1)) for _ in range(40_000)] + [(at(1), "a", None), (None, "a", 1.0)]
    df = spark.createDataFrame(rows, "ts timestamp, service string, v double").repartition(8)
    minutes = T.percentile_sketches(df, "v", "1 minute", ["service"], k).checkpoint()
    assert minutes.agg(F.sum("n")).first()[0] == 40_000 and minutes.count() == 240
    hours = T.merge_sketches(minutes, "1 hour")
    for p in (0.05, 0.5, 0.95, 0.999):
        for r in T.sketched_percentile(hours, p).collect():
            values = [v for t, s, v in rows if t and v is not None and s == r.service and (t - r.bucket.replace(tzinfo=t.tzinfo)).total_seconds() // 3600 == 0]
            below, upto = exact_rank(values, r.percentile)
            assert len(values) == r.n and below - 2 * T.rank_error(k) <= p <= upto + 2 * T.rank_error(k)
    alone = T.sketched_percentile(T.merge_sketches(minutes, "2 hours", by=[]), 0.5).collect()
    assert sum(r.n for r in alone) == 40_000


def test_percentile_from_a_sketch(spark):
    df = spark.createDataFrame([(at(i % 60), "a", float(i)) for i in range(100)], "ts timestamp, service string, network_latency_ms double")
    (row,) = T.latency_percentile(df, p=0.5, exact=False).collect()
    assert abs(row.percentile - 50) <= 1 and row.service == "a" and row.bucket is not None
