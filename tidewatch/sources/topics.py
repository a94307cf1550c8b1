"""Topics of JSON records: read, write, union. Kafka and folders of JSON lines share one typed layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalars import as_col
from tidewatch.schemas import TOPICS

MALFORMED = "_malformed"


def _schema(name: str, schema: str | T.StructType | None) -> T.StructType:
    schema = schema or TOPICS[name]
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def parse_values(df: DataFrame, schema: str | T.StructType, value: str = "value", empty_as: str = "{}") -> DataFrame:
    """Decode a column of JSON text into typed columns; other columns are kept.

    A missing or empty value is read as ``empty_as``. The text of a record that is no JSON object of this
    layout is kept in ``_malformed``, which is null for good records.
    """
    schema = _schema("", schema)
    body = as_col(value).cast("string")
    text = F.when(body.isNull() | (F.trim(body) == ""), F.lit(empty_as)).otherwise(body)
    wide = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    record = F.from_json(text, wide, options)
    rest = [c for c in df.columns if c != value and c not in {*schema.names, MALFORMED}]
    return df.withColumn("_record", record).select(*rest, "_record.*")


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): good records without the marker column, bad ones with their text only."""
    bad = F.col(MALFORMED).isNotNull()
    good = df.filter(~bad).drop(MALFORMED)
    return good, df.filter(bad).select(F.col(MALFORMED).alias("value"))


def _kafka(spark: SparkSession, topics: Sequence[str], start: str, stream: bool, options: Mapping[str, str]) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).format("kafka").options(**options)
    reader = reader.option("subscribe", ",".join(topics))
    # A batch read always ends at the newest record, so "latest" only makes sense for a stream.
    reader = reader.option("startingOffsets", start if stream else "earliest").option("includeHeaders", "true")
    return reader.load().select("topic", "partition", "offset", "headers", "value")


def _cutoff(spark: SparkSession, path: str, checkpoint: str | None) -> str:
    """Up to when files count as old: kept beside the checkpoint once it is known, and read again after that."""
    if checkpoint is None:
        raise ValueError("start='latest' on a folder needs the checkpoint that the query will use")
    kept = f"{checkpoint.rstrip('/')}-start"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(kept)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        newest = spark.read.format("binaryFile").load(path).agg(F.max("modificationTime").cast("string").alias("value"))
        newest.select(F.coalesce("value", F.lit("1970-01-01 00:00:00")).alias("value")).write.text(kept)
    return spark.read.text(kept).first()["value"]


def read_topic(
    spark: SparkSession,
    name: str,
    schema: str | T.StructType | None = None,
    fmt: str = "json",
    path: str | None = None,
    start: str = "earliest",
    stream: bool = False,
    empty_as: str = "{}",
    options: Mapping[str, str] | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Typed records of one topic, with ``topic`` and, from Kafka, partition, offset and headers.

    ``fmt="kafka"`` subscribes to the topic (``options`` name the brokers); ``fmt="json"`` reads JSON lines
    below ``path``. ``start`` is earliest or latest: it counts for the first run of a streaming query, after
    that its checkpoint does. For folders, latest skips files that are there when the stream is first defined; ``checkpoint`` names the
    query's checkpoint folder, beside which that moment is kept, so that a restart delivers what came meanwhile.
    """
    layout = _schema(name, schema)
    options = dict(options or {})
    if fmt == "kafka":
        raw = _kafka(spark, [name], start, stream, options)
    elif fmt == "json":
        if path is None:
            raise ValueError("fmt='json' needs a path")
        if start == "latest" and stream:
            options["_after"] = _cutoff(spark, path, checkpoint)
        after = options.pop("_after", None)
        lines = (spark.readStream if stream else spark.read).options(**options).schema("value string").format("text")
        raw = lines.load(path)
        if after is not None:
            raw = raw.filter(F.col("_metadata.file_modification_time") > F.lit(after).cast("timestamp"))
        raw = raw.withColumn("topic", F.lit(name))
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return parse_values(raw, layout, empty_as=empty_as)


def read_topics(
    spark: SparkSession,
    names: Sequence[str],
    fmt: str = "json",
    paths: Mapping[str, str] | None = None,
    start: str = "earliest",
    stream: bool = False,
    options: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Several topics, each typed by its own layout. From Kafka this is one subscription, split by topic."""
    if fmt == "kafka":
        raw = _kafka(spark, names, start, stream, dict(options or {}))
        return {n: parse_values(raw.filter(F.col("topic") == n), TOPICS[n]) for n in names}
    return {n: read_topic(spark, n, fmt=fmt, path=(paths or {})[n], start=start, stream=stream, options=options) for n in names}


def to_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Each row as one JSON text in ``value``; null fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def write_topic(
    df: DataFrame,
    name: str,
    fmt: str = "json",
    path: str | None = None,
    mode: str = "append",
    options: Mapping[str, str] | None = None,
) -> None:
    """Append a batch to a topic. Streams use ``streaming.sinks.write_topic_stream``."""
    values = to_values(df)
    if fmt == "kafka":
        values.write.format("kafka").options(**dict(options or {})).option("topic", name).save()
    else:
        values.write.mode(mode).options(**dict(options or {})).text(path)


def union_topics(frames: Mapping[str, DataFrame]) -> DataFrame:
    """All topics in one frame with a ``topic`` column; a field that a topic lacks is null.

    A field whose type differs between topics becomes text. Each branch has a constant topic, so a later
    filter on ``topic`` removes whole branches from the plan.
    """
    types: dict[str, set[str]] = {}
    for df in frames.values():
        for f in df.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    mixed = {c for c, seen in types.items() if len(seen) > 1}
    out = None
    for name, df in frames.items():
        typed = df.withColumns({c: F.col(c).cast("string") for c in df.columns if c in mixed} | {"topic": F.lit(name)})
        out = typed if out is None else out.unionByName(typed, allowMissingColumns=True)
    if out is None:
        raise ValueError("no topics given")
    return out
