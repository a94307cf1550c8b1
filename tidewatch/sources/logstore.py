"""The labelled log store: one line per record with labels source, topic, service and severity."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.functions.scalars import iso_z, parse_ts
from tidewatch.operators.timeline import tail
from tidewatch.session import shared_dir
from tidewatch.sources.topics import union_topics

LABELS = ("source", "topic", "service", "severity")
PARTITIONS = ("dt", "topic", "severity")


def normalize_log_lines(df: DataFrame, topic: str | None = None, now: Column | None = None, clock: tuple[str, ...] = ("ts", "seq")) -> DataFrame:
    """Records of a topic as log lines.

    A text message is kept, any other message becomes JSON text, and a record without message becomes JSON of
    the whole record. Missing service, severity and topic become unknown, info and unknown; blank ones stay.
    ``ts`` is the parsed record time, or ``now`` where there is none. ``line`` is the JSON of the whole record, topic and (from
    Kafka) partition, offset and headers included. The ``clock`` columns are not part of the record.
    """
    now = F.current_timestamp() if now is None else now
    name = F.lit(topic) if topic is not None else (F.col("topic") if "topic" in df.columns else F.lit(None))
    body = [c for c in df.columns if c not in clock and c != "topic"]
    record = F.to_json(F.struct(*body, name.cast("string").alias("topic")))
    if "message" in df.columns:
        plain = df.schema["message"].dataType.simpleString() == "string"
        own = F.col("message") if plain else F.to_json(F.struct(F.col("message").alias("m")))
        own = own if plain else F.when(F.col("message").isNotNull(), F.substr(own, F.lit(6), F.length(own) - F.lit(6)))
        message = F.coalesce(own, record)
    else:
        message = record

    def label(column: str, default: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(default)) if column in df.columns else F.lit(default)

    given = F.col("timestamp").cast("string") if "timestamp" in df.columns else F.lit(None).cast("string")
    at = F.coalesce(parse_ts(given), F.col("ts").cast("timestamp") if "ts" in clock and "ts" in df.columns else now, now)
    return df.select(
        F.coalesce(name.cast("string"), F.lit("unknown")).alias("topic"),
        *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in (("partition", "int"), ("offset", "bigint"))],
        label("service", "unknown").alias("service"),
        label("severity", "info").alias("severity"),
        message.alias("message"),
        record.alias("line"),
        F.coalesce(given, iso_z(at)).alias("timestamp"),
        at.alias("ts"),
        (F.col("seq") if "seq" in df.columns else F.lit(None).cast("bigint")).alias("seq"),
        now.alias("ingested_at"),
    )


def attach_labels(df: DataFrame, source: str = "ops") -> DataFrame:
    return df.withColumn("source", F.lit(source))


def log_lines(frames: Mapping[str, DataFrame], source: str = "ops", now: Column | None = None) -> DataFrame:
    """All topics as labelled log lines. Each topic is rendered from its own fields before the union."""
    lines = {n: normalize_log_lines(df, n, now) for n, df in frames.items()}
    return attach_labels(union_topics(lines), source)


def _record(df: DataFrame) -> Column:
    return F.try_parse_json("line" if "line" in df.columns else "message")


def with_record(df: DataFrame) -> DataFrame:
    """Adds ``record``: the whole record (``line``, or the message of lines kept without it) as a parsed value, null where it is no JSON."""
    return df.withColumn("record", _record(df))


def write_log_store(df: DataFrame, path: str, mode: str = "append", files: int | None = None) -> None:
    """Write log lines as Parquet, partitioned by day, topic and severity and clustered by service and time.

    Rows are ranged over the partition columns followed by service and time, so a large partition is
    shared by several tasks and each file covers few services and a short time. Beside its text a line keeps its record parsed, for
    readers that ask for fields.
    """
    dated = df.withColumn("dt", F.to_date("ts"))
    order = [*PARTITIONS, "service", "ts", "seq"]
    ranged = dated.repartitionByRange(files, *order) if files else dated.repartitionByRange(*order)
    # Parsed behind the shuffle, which would sample and carry it.
    with_record(ranged.sortWithinPartitions(*order)).write.mode(mode).partitionBy(*PARTITIONS).parquet(path)


def read_log_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def apply_retention(df: DataFrame, now: Column | datetime | str, hours: int = 168, ts: str = "ts") -> DataFrame:
    """Rows no older than ``hours``. With a ``dt`` column whole days are skipped before the row test."""
    now = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    cutoff = now - F.expr(f"INTERVAL {hours} HOURS")
    out = df.filter(F.col("dt") >= F.to_date(cutoff)) if "dt" in df.columns else df
    return out.filter(F.col(ts) >= cutoff)


def rewrite_log_store(
    spark: SparkSession, path: str, out: str, now: Column | datetime | str, hours: int = 168, files: int | None = None
) -> None:
    """Write the retained part of a store to a new folder, in few well-clustered files."""
    kept = apply_retention(read_log_store(spark, path), now, hours)
    write_log_store(kept.drop("dt"), out, mode="overwrite", files=files)


class Partition(NamedTuple):
    """A folder of the store; ``day`` is None for lines without a time."""

    day: date | None
    topic: str
    severity: str
    path: str


def folders_of(spark: SparkSession, path: str) -> list:
    """The folders directly below a folder, hidden ones left out."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
    return [p for p in found if not p.getName().startswith(("_", "."))]


def _label(name: str) -> str:
    return unquote(name.split("=", 1)[1])


def store_days(spark: SparkSession, path: str) -> dict[date | None, str]:
    """The days of a store, newest first, with their folders; lines without a time come last. Only the store's top folder is listed."""
    found = {}
    for folder in folders_of(spark, path):
        value = _label(folder.getName())
        found[None if value == "__HIVE_DEFAULT_PARTITION__" else date.fromisoformat(value)] = str(folder)
    return dict(sorted(found.items(), key=lambda x: (x[0] is not None, x[0] or date.min), reverse=True))


def day_partitions(spark: SparkSession, day: date | None, path: str) -> list[Partition]:
    """The folders of one day: one per topic and severity."""
    return [
        Partition(day, _label(topic.getName()), _label(severity.getName()), str(severity))
        for topic in folders_of(spark, path)
        for severity in folders_of(spark, str(topic))
    ]


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _day(spark: SparkSession, path: str, folders: list[str], schema: StructType | None = None) -> DataFrame:
    """Some days of a store, without a look at the others."""
    reader = spark.read.option("basePath", path)
    return (reader if schema is None else reader.schema(schema)).parquet(*folders)


def tail_store(spark: SparkSession, path: str, n: int = 100, **labels: str) -> DataFrame:
    """The newest ``n`` lines of a store with the given labels, newest first.

    Days are opened from the newest backwards, each time twice as many, and no more once ``n`` lines are certain: a line of an earlier day is
    older. Lines without a time come last.
    """
    shared_dir(spark)
    days = list(store_days(spark, path).values())
    if not days:
        return tail(read_log_store(spark, path), n, **labels)
    schema = _day(spark, path, days[:1]).schema
    opened = 1
    while True:
        found = tail(_day(spark, path, days[:opened], schema), n, **labels).checkpoint()
        if opened >= len(days) or found.count() >= n:
            return found
        opened *= 2


class Retained(NamedTuple):
    """What a run of ``retain_log_store`` did: days dropped, folders of the boundary day dropped and rewritten."""

    days: tuple[date, ...]
    dropped: tuple[Partition, ...]
    rewritten: tuple[Partition, ...]


def retain_log_store(spark: SparkSession, path: str, now: Column | datetime | str, hours: int = 168) -> Retained:
    """Drop lines older than ``hours`` from a store, where it lies.

    Whole days go as folders. Of the day of the boundary, a folder (topic, severity) whose lines are all too old goes, one without such
    lines stays as it is, and only the others are rewritten, by Spark's dynamic partition overwrite. Later days are not opened. Lines without a
    time are never too old. Run it again after a failure, or at any time: what is done stays done.
    """
    now = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    cutoff = spark.range(1).select((now - F.expr(f"INTERVAL {hours} HOURS")).alias("t"), F.to_date(now - F.expr(f"INTERVAL {hours} HOURS")).alias("d")).first()
    days = store_days(spark, path)
    old = sorted(d for d in days if d is not None and d < cutoff["d"])
    for day in old:
        drop_folder(spark, days[day])
    if cutoff["d"] not in days:
        return Retained(tuple(old), (), ())
    boundary = _day(spark, path, [days[cutoff["d"]]])
    schema = boundary.schema
    late = F.col("ts") < F.lit(cutoff["t"])
    counts = boundary.groupBy("topic", "severity").agg(F.count("*").alias("n"), F.count(F.when(late, 1)).alias("late")).collect()  # one row per folder
    state = {(r["topic"], r["severity"]): "stays" if not r["late"] else "goes" if r["late"] == r["n"] else "shrinks" for r in counts}
    parts = {what: tuple(p for p in day_partitions(spark, cutoff["d"], days[cutoff["d"]]) if state.get((p.topic, p.severity)) == what) for what in ("goes", "shrinks")}
    if parts["shrinks"]:
        labels = spark.createDataFrame([(p.topic, p.severity) for p in parts["shrinks"]], "topic string, severity string")
        order = [*PARTITIONS, "service", "ts", "seq"]
        kept = boundary.filter(~late).join(F.broadcast(labels), ["topic", "severity"], "left_semi")
        writer = kept.select(*schema.names).repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path)
    for p in parts["goes"]:
        drop_folder(spark, p.path)
    return Retained(tuple(old), parts["goes"], parts["shrinks"])


def select_logs(
    df: DataFrame,
    json_fields: Mapping[str, str] | None = None,
    where: Column | str | None = None,
    **labels: str,
) -> DataFrame:
    """Lines whose labels equal the given values; on a written store topic and severity prune partitions.

    ``json_fields`` maps new columns to paths such as ``$.trace_id`` in the whole record, which a written store keeps parsed and which
    is parsed once elsewhere; a field whose name is already a label does not replace it. ``where`` filters after the extraction.
    """
    out = df
    for name, value in labels.items():
        out = out.filter(F.col(name) == value)
    wanted = {c: p for c, p in (json_fields or {}).items() if c not in LABELS}
    if wanted:
        # Behind the generator the record is a column like any other: a filter on a field does not render and parse the line anew.
        parsed = out if "record" in out.columns else out.select("*", F.inline(F.array(F.struct(_record(out).alias("record")))))
        out = parsed.select(*[c for c in out.columns if c not in wanted], *[F.try_variant_get("record", p, "string").alias(c) for c, p in wanted.items()])
    return out if where is None else out.filter(where)
