"""Metric records: rolling features, threshold flags and anomaly typing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import canonical_json, num_default, or_default, safe_ratio
from tidewatch.operators.blocks import rolling
from tidewatch.schemas import METRICS_RAW

FEATURES = ("cpu_avg_5", "memory_avg_5", "latency_avg_5")
VALUES = {"cpu_percent": "cpu", "memory_percent": "memory", "network_latency_ms": "latency"}
_RAW = {f.split()[0] for f in METRICS_RAW.split(", ")}


def threshold_flags(df: DataFrame, cpu: float = 80, mem: float = 85, lat: float = 200) -> DataFrame:
    """Strictly above the limit counts as high."""
    return df.withColumns(
        {
            "is_high_cpu": F.col("cpu_percent") > cpu,
            "is_high_memory": F.col("memory_percent") > mem,
            "is_high_latency": F.col("network_latency_ms") > lat,
        }
    )


def metric_severity(df: DataFrame) -> DataFrame:
    """High latency gives error, else high cpu or memory gives warn, else info."""
    severity = (
        F.when(F.col("is_high_latency"), "error")
        .when(F.col("is_high_cpu") | F.col("is_high_memory"), "warn")
        .otherwise("info")
    )
    return df.withColumn("severity", severity)


def prepare_metrics(df: DataFrame) -> DataFrame:
    """The used fields of raw metrics with their defaults; columns outside the raw layout are kept."""
    return df.select(
        "timestamp",
        or_default("service", "unknown").alias("service"),
        *[num_default(c).alias(c) for c in VALUES],
        *[c for c in df.columns if c not in _RAW],
    )


def rolling_stats(
    df: DataFrame,
    n: int = 5,
    by: str | None = None,
    stats: Sequence[str] = ("avg",),
    order: Sequence[str] = ("ts", "seq"),
) -> DataFrame:
    """Rolling statistics of the three metric values over the last ``n`` rows.

    ``by=None`` runs one window over all services together, ``by="service"`` one per service. Columns are
    named ``cpu_avg_5`` and so on. Runs a job: see ``blocks``.
    """
    out = rolling(df, [by] if by else [], list(order), {c: list(stats) for c in VALUES}, n)
    names = {f"{c}_{s}": f"{short}_{s}_{n}" for c, short in VALUES.items() for s in stats}
    return out.withColumnsRenamed(names)


def finish_metrics(df: DataFrame) -> DataFrame:
    """Flags, severity and ratio on prepared metrics that already have their averages."""
    out = metric_severity(threshold_flags(df))
    return out.withColumn("cpu_to_memory_ratio", safe_ratio("cpu_percent", "memory_percent", 4))


def enrich_metrics(
    df: DataFrame, n: int = 5, by: str | None = None, order: Sequence[str] = ("ts", "seq")
) -> DataFrame:
    """Raw metrics to enriched metrics. Disk, request and error rates are not carried on."""
    return finish_metrics(rolling_stats(prepare_metrics(df), n, by, order=order))


def features(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """The model's input vector; a missing value counts as 0."""
    return df.withColumn("features", F.array(*[num_default(c) for c in columns]))


def type_anomalies(df: DataFrame, cpu: float = 80, mem: float = 85, lat: float = 200) -> DataFrame:
    """Name flagged rows by their averages, cpu before latency before memory, as ml_output records.

    Needs ``is_anomaly`` and ``anomaly_score``; columns outside the enriched layout are kept.
    """
    checks = (
        ("cpu_avg_5", cpu, "CPU_SPIKE", "warn"),
        ("latency_avg_5", lat, "LATENCY_SPIKE", "error"),
        ("memory_avg_5", mem, "MEMORY_SPIKE", "warn"),
    )
    flagged = F.coalesce(F.col("is_anomaly"), F.lit(False))
    kind, severity = F.when(~flagged, "NONE"), F.when(~flagged, "info")
    for column, limit, name, level in checks:
        kind = kind.when(num_default(column) > limit, name)
        severity = severity.when(num_default(column) > limit, level)
    own = {
        "timestamp", "service", "severity", "cpu_percent", "memory_percent", "network_latency_ms",
        "cpu_to_memory_ratio", "is_high_cpu", "is_high_memory", "is_high_latency", "is_anomaly",
        "anomaly_score", "anomaly_type", *FEATURES,
    }
    return df.select(
        "timestamp",
        F.coalesce("service", F.lit("unknown")).alias("service"),
        severity.otherwise("warn").alias("severity"),
        kind.otherwise("UNKNOWN_ANOMALY").alias("anomaly_type"),
        F.col("anomaly_score").cast("double").alias("anomaly_score"),
        flagged.alias("is_anomaly"),
        *[num_default(c).alias(c) for c in FEATURES],
        *[c for c in df.columns if c not in own],
    )


ML_FIELDS = (
    "timestamp", "service", "severity", "anomaly_type", "anomaly_score", "is_anomaly", *FEATURES
)


def anomaly_incidents(df: DataFrame) -> DataFrame:
    """Flagged ml_output records as incident records; extra columns are kept."""
    anomaly = canonical_json({c: F.col(c) for c in ML_FIELDS})
    return df.filter(F.col("is_anomaly")).select(
        "timestamp",
        or_default("service", "unknown").alias("service"),
        F.coalesce("severity", F.lit("warn")).alias("severity"),
        or_default("anomaly_type", "UNKNOWN_ANOMALY").alias("incident_type"),
        F.lit("ml_output").alias("source"),
        canonical_json({"anomaly": anomaly}, raw=("anomaly",)).alias("details"),
        *[c for c in df.columns if c not in ML_FIELDS],
    )
