"""Log, metric and anomaly records at every boundary."""

import json

from tests.conftest import at, iso
from tidewatch.operators import logs as L
from tidewatch.operators import metrics as M
from tidewatch.schemas import LOGS_RAW, METRICS_RAW, ML_OUTPUT


def test_normalize_logs(spark):
    rows = [
        ("t", None, None, None, None),
        ("t", "", "", "", "x"),
        ("t", "s", "fatal", "m", "x"),
        ("t", "s", "Warning", "m", "x"),
        ("t", "s", "trace", "m", "x"),
        ("t", " ", " error", "m", "x"),
    ]
    got = [tuple(r) for r in L.normalize_logs(spark.createDataFrame(rows, LOGS_RAW)).collect()]
    assert got == [
        ("t", "unknown", "", "info", None, "INFO"),
        ("t", "unknown", "", "info", "x", "INFO"),
        ("t", "s", "m", "critical", "x", "FATAL"),
        ("t", "s", "m", "warn", "x", "WARNING"),
        ("t", "s", "m", "info", "x", "TRACE"),
        ("t", " ", "m", "info", "x", " ERROR"),
    ]


def parsed(spark, rows):
    full = [("t", s, m, sev, "x", "L", i) for i, (s, m, sev) in enumerate(rows)]
    return spark.createDataFrame(
        full, "timestamp string, service string, message string, severity string, trace_id string, original_level string, seq bigint"
    )


def test_keywords_first_match_and_floors(spark):
    rows = [
        ("a", "Authentication FAILED, cache miss", "info"),
        ("a", "authentication failed", "warn"),
        ("a", "authentication failed", "debug"),
        ("a", "authentication failed", "critical"),
        ("a", "db latency up", "info"),
        ("a", "DB connection slow", "warn"),
        ("a", "Request timeout", "warn"),
        ("a", "cache storm", None),
        ("a", "cache miss", "ERROR"),
        ("", "cache miss", "info"),
        ("a", "nothing", "error"),
        ("a", None, "error"),
    ]
    out = L.log_incidents(parsed(spark, rows)).orderBy("seq").collect()
    assert [(r.seq, r.incident_type, r.severity, r.service) for r in out] == [
        (0, "AUTH_FAILURE", "error", "a"),
        (1, "AUTH_FAILURE", "error", "a"),
        (2, "AUTH_FAILURE", "debug", "a"),
        (3, "AUTH_FAILURE", "critical", "a"),
        (4, "DB_LATENCY", "warn", "a"),
        (5, "DB_LATENCY", "warn", "a"),
        (6, "REQUEST_TIMEOUT", "error", "a"),
        (7, "CACHE_STORM", "warn", "a"),
        (8, "CACHE_STORM", "error", "a"),
        (9, "CACHE_STORM", "warn", "unknown"),
    ]
    assert json.loads(out[0].details)["log"]["message"] == rows[0][1]
    assert json.loads(out[9].details)["service"] == "unknown"


def test_metric_flags_are_strict_and_latency_wins(spark):
    rows = [
        (80.0, 85.0, 200.0), (80.01, 0.0, 0.0), (0.0, 85.01, 0.0), (99.0, 99.0, 200.01), (None, None, None)
    ]
    full = [(iso(i), None, "x", c, m, 1, lat, 1, 0.1, at(i), i) for i, (c, m, lat) in enumerate(rows)]
    df = spark.createDataFrame(full, METRICS_RAW + ", ts timestamp, seq bigint")
    out = M.enrich_metrics(df).orderBy("seq").collect()
    assert [r.severity for r in out] == ["info", "warn", "warn", "error", "info"]
    assert [(r.is_high_cpu, r.is_high_memory, r.is_high_latency) for r in out][3] == (True, True, True)
    assert out[4].cpu_percent == 0.0 and out[4].service == "unknown" and out[4].cpu_to_memory_ratio == 0.0
    assert out[0].cpu_to_memory_ratio == round(80 / 85, 4)
    assert "disk_io" not in out[0].asDict()


def test_anomaly_typing_order(spark):
    rows = [
        (81.0, 90.0, 300.0, True),
        (80.0, 90.0, 300.0, True),
        (80.0, 85.01, 200.0, True),
        (80.0, 85.0, 200.0, True),
        (99.0, 99.0, 999.0, False),
        (None, None, None, True),
    ]
    df = spark.createDataFrame(
        [(iso(i), "s", "info", c, m, lat, -0.1, a, i) for i, (c, m, lat, a) in enumerate(rows)],
        "timestamp string, service string, severity string, cpu_avg_5 double, memory_avg_5 double, "
        "latency_avg_5 double, anomaly_score double, is_anomaly boolean, seq bigint",
    )
    out = M.type_anomalies(df).orderBy("seq").collect()
    assert [(r.anomaly_type, r.severity) for r in out] == [
        ("CPU_SPIKE", "warn"),
        ("LATENCY_SPIKE", "error"),
        ("MEMORY_SPIKE", "warn"),
        ("UNKNOWN_ANOMALY", "warn"),
        ("NONE", "info"),
        ("UNKNOWN_ANOMALY", "warn"),
    ]
    assert M.features(df).orderBy("seq").collect()[5].features == [0.0, 0.0, 0.0]


def test_metric_outlier_is_a_latency_spike(spark):
    df = spark.createDataFrame(
        [("t", "unique", "info", 20.0, 30.0, 800.0, -0.2, True)],
        "timestamp string, service string, severity string, cpu_avg_5 double, memory_avg_5 double, "
        "latency_avg_5 double, anomaly_score double, is_anomaly boolean",
    )
    row = M.type_anomalies(df).first()
    assert (row.anomaly_type, row.severity) == ("LATENCY_SPIKE", "error")


def test_anomaly_incidents(spark):
    rows = [
        ("t", "", None, "", -0.1, True, 1.0, 2.0, 3.0),
        ("t", "s", "warn", "CPU_SPIKE", -0.1, True, 1.0, 2.0, 3.0),
        ("t", "s", "warn", "NONE", 0.1, False, 1.0, 2.0, 3.0),
        ("t", "s", "warn", "NONE", 0.1, None, 1.0, 2.0, 3.0),
    ]
    out = M.anomaly_incidents(spark.createDataFrame(rows, ML_OUTPUT)).collect()
    assert [(r.service, r.severity, r.incident_type) for r in out] == [
        ("unknown", "warn", "UNKNOWN_ANOMALY"),
        ("s", "warn", "CPU_SPIKE"),
    ]
    assert json.loads(out[1].details)["anomaly"]["cpu_avg_5"] == 1.0
