"""Topic records made from the columns of an ``events`` table (event_id, ts, user_id, event_type, value, props).

Every event becomes one log and one metric record. Event n happens n seconds after the start of 2024, so
windows of seconds hold several events; ``seq`` is the event id. ``happened_at`` keeps the table's own time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.scalars import iso_z, lookup

CLOCK_START = 1_704_067_200  # 2024-01-01 00:00:00 UTC
SERVICES = ("payments", "orders", "auth", "db")
LEVELS = {"error": "ERROR", "signup": "Warning", "purchase": "DEBUG", "view": "INFO"}


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    if stream:
        table = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events*.parquet").parquet(folder)
    else:
        table = spark.read.parquet(f"{folder}/events.parquet")
    ts = F.timestamp_seconds(F.lit(CLOCK_START) + F.col("event_id"))
    return table.select(
        F.col("event_id").alias("seq"),
        ts.alias("ts"),
        F.col("ts").cast("timestamp").alias("happened_at"),
        iso_z(ts).alias("timestamp"),
        lookup((F.col("user_id") % 4).cast("string"), {str(i): s for i, s in enumerate(SERVICES)}).alias("service"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def logs_raw(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    digit = F.col("k") % 10
    message = (
        F.when(digit == 0, F.concat(F.lit("sign-in refused, authentication failed: account "), F.col("user_id").cast("string")))
        .when(digit == 1, "pool warning: db connection slow again")
        .when(digit == 2, "no answer in time, request timeout at the till")
        .when(digit == 3, "too many a cache miss since midnight")
        .otherwise(F.concat(F.lit("nothing to report, entry "), F.col("seq").cast("string")))
    )
    return events(spark, folder, stream).select(
        "timestamp",
        "service",
        lookup("event_type", LEVELS).alias("level"),
        message.alias("message"),
        F.concat(F.lit("trace-"), F.col("seq").cast("string")).alias("trace_id"),
        "ts",
        "seq",
    )


def metrics_raw(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    return events(spark, folder, stream).select(
        "timestamp",
        "service",
        (F.col("value") % 100).alias("cpu_percent"),
        F.col("k").cast("double").alias("memory_percent"),
        F.col("value").alias("network_latency_ms"),
        "ts",
        "seq",
    )


def flag_by_limits(df: DataFrame, cpu: float = 50, mem: float = 60, lat: float = 90) -> DataFrame:
    """A deterministic stand-in for the model: flag averages over fixed limits, score by the distance."""
    cpu_over = F.col("cpu_avg_5") - cpu
    mem_over = F.col("memory_avg_5") - mem
    lat_over = F.col("latency_avg_5") - lat
    over = F.greatest(cpu_over, mem_over, lat_over)
    return df.withColumns({"anomaly_score": -over / 100, "is_anomaly": over > 0})


def spelled_service() -> Column:
    """The service in one of the spellings producers use, picked by ``seq``: case, suffix, blanks, unknown, empty."""
    s, way = F.col("service"), F.col("seq") % 6
    return (
        F.when(way == 0, F.upper(s))
        .when(way == 1, F.concat(s, F.lit("-service")))
        .when(way == 2, F.concat(F.lit("  "), s, F.lit(" ")))
        .when(way == 3, "unknown")
        .when(way == 4, "")
        .otherwise(s)
    )


def spelled_severity() -> Column:
    s, way = F.col("severity"), F.col("seq") % 3
    return F.when(way == 0, F.upper(s)).when((way == 1) & (s == "warn"), " Warning").otherwise(s)


def approvals_of(intents: DataFrame) -> DataFrame:
    """Approval events for intents, chosen by the digits of the action id: who answers, how, and how late."""
    first, second = F.substring("action_id", 1, 1), F.substring("action_id", 2, 1)
    decision = (
        F.when(first.between("0", "2"), "approve")
        .when(first.between("3", "4"), " YES ")
        .when(first.between("5", "7"), "Denied")
        .when(first.between("8", "9"), "n")
        .when(first.between("a", "b"), "maybe")
    )
    late = F.when(second.between("0", "9"), 60).otherwise(1000)
    return intents.withColumn("decision", decision).filter(F.col("decision").isNotNull()).select(
        F.lit("ACTION_APPROVAL").alias("event_type"),
        "action_id",
        "decision",
        F.lit("operator").alias("approver"),
        F.timestamp_seconds(F.unix_seconds("ts") + late).alias("ts"),
        "seq",
    )
