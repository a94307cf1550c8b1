"""Every registered query against its SQL on the smallest tables, and the plans that must hold at scale."""

import os
import re
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import TABLES, canonical
from tidewatch.operators.blocks import rolling
from tidewatch.operators.joins import broadcast_if_small
from tidewatch.operators.lifecycle import lifecycle
from tidewatch.operators.remediation import canonicalize_incidents, match_rules
from tidewatch.operators.timeline import freshness, query_range
from tidewatch.plans import event_views as V
from tidewatch.plans.registered import parsed, store
from tidewatch.sources.logstore import read_log_store, select_logs, write_log_store
from tidewatch.sources.rulebook import load_rules

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(rows, df.columns) == canonical(result.fetchall(), columns)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_rules_and_aliases_are_broadcast(spark):
    book = load_rules(spark)
    from tidewatch.operators.logs import log_incidents

    incidents = log_incidents(parsed(spark, FOLDER))
    plan = plan_of(match_rules(canonicalize_incidents(incidents, book.aliases), book.rules))
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_rolling_adds_no_exchange_after_the_blocks(spark):
    df = V.metrics_raw(spark, FOLDER)
    plan = plan_of(rolling(df, [], ["ts", "seq"], {"cpu_percent": ["avg"]}, 5))
    assert "Exchange" not in plan and "Window" not in plan


def test_filter_on_topic_drops_the_other_topics(spark):
    plan = plan_of(select_logs(store(spark, FOLDER), topic="logs_parsed"))
    assert plan.count("Scan parquet") == 1


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(entry.queries()["metric_series"](spark, FOLDER))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "event_type" not in schema and "ts:" not in schema


def test_days_outside_the_range_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "store")
    write_log_store(store(spark, FOLDER), path)
    lines = read_log_store(spark, path)
    ranged = plan_of(query_range(lines, "2024-01-01 00:05:00", "2024-01-01 00:15:00", 20, topic="logs_parsed"))
    recent = plan_of(freshness(lines, "2024-01-01 00:10:00", known=["logs_parsed", "nowhere"]))
    for plan in (ranged, recent):
        assert re.search(r"PartitionFilters: \[[^]]*dt#", plan)
    found = {r.topic: (r.newest, r.fresh) for r in freshness(lines, "2024-01-01 00:10:00", known=["logs_parsed", "nowhere"]).collect()}
    assert found["nowhere"] == (None, False) and found["logs_parsed"][1]


def test_incidents_without_action_do_not_meet_in_one_task(spark):
    ids = spark.range(4000).select(F.col("id").cast("string").alias("incident_id"), F.timestamp_seconds("id").alias("ts"))
    incidents = ids.withColumns({"service": F.lit("s"), "incident_type": F.lit("t")})
    acted = ids.filter(F.col("incident_id").cast("long") % 100 == 0).withColumn("action_id", F.concat(F.lit("a"), "incident_id"))
    intents = acted.withColumns({c: F.lit("x") for c in ("rule_id", "action_type", "target_service")})
    results = acted.select("action_id", F.lit("SUCCESS").alias("status"), F.col("ts").alias("result_at"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lifecycle(incidents, intents, results)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_size_of_a_broadcast_side_is_added_up_in_its_partitions(spark):
    small = spark.range(10)
    assert "broadcast" in plan_of(spark.range(10).join(broadcast_if_small(small), "id")).lower()
    assert broadcast_if_small(small, max_bytes=10) is small


def test_package_reaches_workers_of_a_driver_elsewhere(tmp_path):
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e; from tidewatch.session import local_session; "
        f"s = local_session(2); print('ROWS', e.queries()['error_bursts'](s, {FOLDER!r}).count())"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]
