"""Error bursts: trailing counts, and bursts that reset the count when they fire."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import canonical_json, iso_z, micros, or_default
from tidewatch.operators.blocks import number_rows, running_total
from tidewatch.operators.joins import picked_and_rest, picked_whole
from tidewatch.operators.logs import LOG_FIELDS, log_json
from tidewatch.operators.spacing import greedy_spacing
from tidewatch.session import shared_dir

SECOND = 1_000_000


def error_logs(df: DataFrame) -> DataFrame:
    """Logs of severity error or critical, in any case, with a service."""
    return df.filter(F.lower("severity").isin("error", "critical")).withColumn("service", or_default("service", "unknown"))


def trailing_count(
    df: DataFrame,
    window_sec: int = 30,
    by: str = "service",
    ts: str = "ts",
    seq: str = "seq",
    name: str = "trailing_count",
) -> DataFrame:
    """Number of rows of the same ``by`` value in [ts - window, ts], the row itself and earlier ones.

    A row exactly ``window_sec`` old counts. The count is the difference of two running totals over sorted blocks: rows up to
    this one, less rows before its window, for which every row adds a weightless marker sorted before the rows of that time. Blocks
    split any service. Rows are numbered in a checkpoint, so records delivered again count each, one after the other; a null
    ``seq`` sorts first, and rows without time or ``by`` stay, with a null count.
    """
    shared_dir(df.sparkSession)
    reach = window_sec * SECOND
    rows = df.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    placed = F.coalesce(F.col(seq).cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    narrow = rows.select(by, micros(ts).alias("_at"), placed.alias("_seq"), "_row").dropna(subset=[by, "_at"])
    ends = narrow.select(by, "_at", F.lit(1).alias("_kind"), "_seq", "_row", F.lit(1).cast("bigint").alias("_w"))
    starts = narrow.select(by, F.col("_at") - reach, F.lit(0), "_seq", "_row", F.lit(0).cast("bigint"))
    ranked = running_total(ends.union(starts), [by], ["_at", "_kind", "_seq", "_row"], "_w", "_upto")
    sign = F.when(F.col("_kind") == 1, F.col("_upto")).otherwise(-F.col("_upto"))
    counts = ranked.groupBy("_row").agg(F.sum(sign).alias(name))
    return rows.join(counts, "_row", "left").drop("_row")


def burst_fires(df: DataFrame, window_sec: int = 30, threshold: int = 8, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """The log records at which a burst fires: (service, _at in microseconds, seq).

    A row can fire when the ``threshold - 1``-th error before it in its service is at most ``window_sec``
    old, and does when at least ``threshold`` errors came since the last fire. Only three narrow columns
    are shuffled, once. Runs jobs, see ``blocks``, and returns the written fires, at most one per
    ``threshold`` errors. A record delivered again counts again. Rows without time or number have no place in
    the order and never fire; ``blocks.unplaced`` gives them for counting or a dead-letter output.
    """
    narrow = error_logs(df).select("service", micros(ts).alias("_at"), seq).dropna()
    numbered = number_rows(
        narrow, ["service"], ["_at", seq], lag_of="_at", lag=threshold - 1, lag_name="_old", keep_block=True
    )
    recent = F.col("_at") - F.col("_old") <= window_sec * SECOND
    candidates = numbered.filter((F.col("rn") >= threshold) & recent).drop("_old")
    # Row numbers grow along the sorted blocks, so the choice needs no further shuffle. It reads the candidates twice.
    candidates = candidates.checkpoint()
    fires = greedy_spacing(candidates, ["service"], "rn", [], threshold, presorted=True)
    return fires.drop("rn").checkpoint()


def fires_whole(df: DataFrame, fires: DataFrame, ts: str = "ts", seq: str = "seq") -> bool:
    """Whether a burst fired on every copy of each log record that it fired on; mostly there is one. Found for all logs, it holds for any of them."""
    keyed = df.select(or_default("service", "unknown").alias("service"), micros(ts).alias("_at"), seq)
    return picked_whole(keyed, fires, ["service", "_at", seq])


def detect_bursts(
    df: DataFrame,
    window_sec: int = 30,
    threshold: int = 8,
    ts: str = "ts",
    seq: str = "seq",
    fires: DataFrame | None = None,
    whole: bool | None = None,
) -> DataFrame:
    """ERROR_RATE_SPIKE incidents of parsed logs; the firing log is the sample in ``details``.

    The fires are joined back to the logs for the sample, as a broadcast when they are few; of copies of one
    record, only as many as fired. Pass the results of ``burst_fires`` and ``fires_whole`` if they are also used elsewhere.
    """
    if fires is None:
        fires = burst_fires(df, window_sec, threshold, ts, seq)
    logs = error_logs(df).withColumn("_at", micros(ts))
    fired, _ = picked_and_rest(logs, fires, ["service", "_at", seq], whole)
    details = canonical_json(
        {
            "window_sec": F.lit(window_sec),
            "count": F.lit(threshold),
            "threshold": F.lit(threshold),
            "sample_log": log_json(),
        },
        raw=("sample_log",),
    )
    return fired.select(
        F.coalesce(F.nullif("timestamp", F.lit("")), iso_z(ts)).alias("timestamp"),
        "service",
        F.lit("critical").alias("severity"),
        F.lit("ERROR_RATE_SPIKE").alias("incident_type"),
        F.lit("logs_parsed").alias("source"),
        details.alias("details"),
        *[c for c in df.columns if c not in LOG_FIELDS],
    )


def all_incidents(
    bursts: DataFrame,
    logs: DataFrame,
    anomalies: DataFrame,
    ts: str = "ts",
    seq: str = "seq",
    fires: DataFrame | None = None,
    whole: bool | None = None,
) -> DataFrame:
    """One incident stream. A log record on which a burst fired gives no keyword incident; other copies of it do.

    ``fires`` is the result of ``burst_fires``, cheaper to test against than ``bursts`` itself.
    """
    if fires is None:
        fires = bursts.select("service", micros(ts).alias("_at"), seq)
    _, keyword = picked_and_rest(logs.withColumn("_at", micros(ts)), fires.select("service", "_at", seq), ["service", "_at", seq], whole)
    return bursts.unionByName(keyword.select(*logs.columns), allowMissingColumns=True).unionByName(
        anomalies, allowMissingColumns=True
    )
