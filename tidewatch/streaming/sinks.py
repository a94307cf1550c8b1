"""Streaming sinks. A checkpoint with a file sink, or one folder per batch id, makes every row count once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tidewatch.functions.scalars import micros
from tidewatch.operators.bursts import SECOND, burst_fires, detect_bursts, error_logs
from tidewatch.operators.joins import broadcast_if_small
from tidewatch.operators.metrics import finish_metrics, prepare_metrics, rolling_stats
from tidewatch.operators.remediation import DEDUP_TTL, apply_cooldown
from tidewatch.schemas import METRICS_RAW
from tidewatch.sources.logstore import PARTITIONS, with_record
from tidewatch.sources.topics import MALFORMED, split_malformed, to_values

Trigger = Mapping[str, object]
# Run over what is there and stop; pass {"processingTime": "10 seconds"} for a lasting query.
AVAILABLE_NOW: Trigger = {"availableNow": True}


def write_topic_stream(
    df: DataFrame,
    name: str,
    checkpoint: str,
    fmt: str = "json",
    path: str | None = None,
    trigger: Trigger = AVAILABLE_NOW,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Send a stream to a topic: Kafka, or a folder of JSON lines that holds each row exactly once."""
    writer = to_values(df).writeStream.queryName(name).option("checkpointLocation", checkpoint).options(**dict(options or {}))
    if fmt == "kafka":
        writer = writer.format("kafka").option("topic", name)
    else:
        writer = writer.format("text").option("path", path)
    return writer.outputMode("append").trigger(**trigger).start()


def write_log_store_stream(df: DataFrame, path: str, checkpoint: str, trigger: Trigger = AVAILABLE_NOW) -> StreamingQuery:
    """Append log lines to the partitioned store."""
    dated = with_record(df).withColumn("dt", F.to_date("ts"))
    writer = dated.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy(*PARTITIONS).outputMode("append").trigger(**trigger).start()


def quarantine(
    df: DataFrame, process: Callable[[DataFrame, int], None], dead_letters: str, checkpoint: str, trigger: Trigger = AVAILABLE_NOW
) -> StreamingQuery:
    """Hand the good records of each batch to ``process`` and keep the text of bad ones in ``dead_letters``.

    ``df`` comes from ``read_topic``. A repeated batch overwrites its own folder of dead letters.
    """
    if MALFORMED not in df.columns:
        raise ValueError("the stream has no malformed marker; read it with read_topic")

    def run(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_malformed(batch)
        bad.write.mode("overwrite").text(f"{dead_letters}/batch={batch_id}")
        process(good, batch_id)

    return df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _replay(
    df: DataFrame,
    out: str,
    carry: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    work: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    trigger: Trigger,
) -> StreamingQuery:
    """Run a batch operator over each micro-batch and the few rows that carry the past into it.

    ``work`` gets the prepared rows with ``_new`` (false for carried ones) and returns the results and the rows to
    carry on. Both go to one folder per batch id, which a repeated batch overwrites: every row takes
    effect once, also after a restart.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        ready = prepare(batch)
        rows = ready.withColumn("_new", F.lit(True))
        if batch_id:
            past = batch.sparkSession.read.schema(ready.schema).parquet(f"{carry}/batch={batch_id - 1}")
            rows = rows.unionByName(past.withColumn("_new", F.lit(False)))
        result, keep = work(rows)
        result.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        keep.select(*ready.columns).write.mode("overwrite").parquet(f"{carry}/batch={batch_id}")

    return df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _latest(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows, per ``by`` values where given. Each task keeps only its own last ``n`` before any shuffle."""
    latest = [F.desc(c) for c in order]
    if not by:
        return df.orderBy(*latest).limit(n)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*latest))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def rolling_sink(
    df: DataFrame,
    out: str,
    carry: str,
    checkpoint: str,
    n: int = 5,
    by: str | None = None,
    order: Sequence[str] = ("ts", "seq"),
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Enriched metrics of a stream, with one window over everything (``by=None``) or per ``by`` value.

    Carries the last ``n - 1`` rows; a busy window spreads over tasks as in the batch form.
    """
    names = {f.split()[0] for f in METRICS_RAW.split(", ")}

    def prepare(batch: DataFrame) -> DataFrame:
        return prepare_metrics(batch.select(*[c for c in batch.columns if c in names or c in order]))

    def work(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        done = rolling_stats(rows, n, by, order=order).filter("_new").drop("_new")
        return finish_metrics(done), _latest(rows.drop("_new"), [by] if by else [], order, n - 1)

    return _replay(df, out, carry, checkpoint, prepare, work, trigger)


def burst_sink(
    df: DataFrame,
    out: str,
    carry: str,
    checkpoint: str,
    window_sec: int = 30,
    threshold: int = 8,
    ts: str = "ts",
    seq: str = "seq",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """ERROR_RATE_SPIKE incidents of a stream of parsed logs, for services too busy for one task.

    Carries, per service, the up to ``threshold - 1`` errors since its last fire; they cannot fire by
    themselves and leave the detector where the batch before ended.
    """

    def work(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        fires = burst_fires(rows, window_sec, threshold, ts, seq)
        found = detect_bursts(rows.drop("_new"), window_sec, threshold, ts, seq, fires=fires)
        last = fires.groupBy("service").agg(F.max(F.struct("_at", F.col(seq).alias("_seq"))).alias("_fired"))
        here = F.struct(micros(ts).alias("_at"), F.col(seq).alias("_seq"))
        later = F.col("_fired").isNull() | (here > F.col("_fired"))
        since = rows.drop("_new").join(broadcast_if_small(last), "service", "left").filter(later)
        return found, _latest(since.drop("_fired"), ["service"], [ts, seq], threshold - 1)

    return _replay(df, out, carry, checkpoint, error_logs, work, trigger)


def cooldown_sink(
    candidates: DataFrame,
    out: str,
    carry: str,
    checkpoint: str,
    ttl: int = DEDUP_TTL,
    ts: str = "ts",
    seq: str = "seq",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Candidates of a stream that become intents, for (rule, target) pairs too busy for one task.

    Carries the emissions whose cooldown or TTL may still matter: those within the longer of both before
    the newest row of their pair. Emissions, replayed on their own, are emitted again.
    """

    def work(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        emitted = apply_cooldown(rows, ttl, ts, seq).checkpoint()
        pair = ["rule_id", "target_service"]
        newest = broadcast_if_small(rows.groupBy(*pair).agg(F.max(micros(ts)).alias("_newest")))
        reach = F.greatest(F.col("cooldown_sec").cast("bigint"), F.lit(ttl).cast("bigint")) * SECOND
        live = emitted.join(newest, pair).filter(micros(ts) + reach >= F.col("_newest")).drop("_newest")
        return emitted.filter("_new").drop("_new"), live

    return _replay(candidates, out, carry, checkpoint, lambda batch: batch, work, trigger)
