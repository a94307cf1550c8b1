"""Dashboard questions over log lines: counts and rates over time, label listings, top-k reads, percentiles."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalars import micros, micros_to_ts
from tidewatch.operators.blocks import running_total
from tidewatch.operators.bursts import SECOND
from tidewatch.operators.joins import broadcast_if_small


def count_over_time(
    df: DataFrame,
    range_sec: int,
    step_sec: int,
    by: Sequence[str] = (),
    ts: str = "ts",
    name: str = "count",
) -> DataFrame:
    """Rows in (t - range, t] for every t on the step grid, per ``by`` values; empty windows give no row.

    Rows are first counted in buckets of the greatest common step, where map-side partial counts absorb
    hot labels; only these counts are then copied to the evaluation times that cover them.
    """
    base = gcd(range_sec, step_sec)
    return count_over_buckets(bucket_counts(df, base, by, ts), base, range_sec, step_sec, by, name)


def bucket_counts(df: DataFrame, base_sec: int, by: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """``bucket, n``: rows in (bucket - base, bucket] per ``by`` values. Rows without a time have no bucket."""
    base = base_sec * SECOND
    bucket = (F.ceil(micros(ts) / base) * base).cast("bigint")
    return df.filter(F.col(ts).isNotNull()).groupBy(micros_to_ts(bucket).alias("bucket"), *by).agg(F.count("*").alias("n"))


def count_over_buckets(buckets: DataFrame, base_sec: int, range_sec: int, step_sec: int, by: Sequence[str] = (), name: str = "count") -> DataFrame:
    """``count_over_time`` from the counts of buckets (see ``bucket_counts``), which may be of finer ``by`` values or several per bucket.

    Range and step must be multiples of the buckets' length.
    """
    if range_sec % base_sec or step_sec % base_sec:
        raise ValueError("range and step must be multiples of the bucket")
    base, step, span = base_sec * SECOND, step_sec * SECOND, range_sec * SECOND
    counts = buckets.groupBy(micros("bucket").alias("_bucket"), *by).agg(F.sum("n").alias("_n"))
    # The bucket (b - base, b] is inside (t - range, t] exactly for b <= t <= b - base + range.
    first = (F.ceil(F.col("_bucket") / step) * step).cast("bigint")
    last = F.col("_bucket") + (span - base)
    times = F.when(first <= last, F.sequence(first, last, F.lit(step).cast("bigint")))
    return (
        counts.withColumn("_t", F.explode(times))
        .groupBy(micros_to_ts("_t").alias("eval_at"), *by)
        .agg(F.sum("_n").alias(name))
    )


def rate(df: DataFrame, range_sec: int, step_sec: int, by: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Rows per second over the trailing range."""
    counts = count_over_time(df, range_sec, step_sec, by, ts)
    return counts.withColumn("rate", F.col("count") / range_sec).drop("count")


def last_value(series: DataFrame, value: str, by: Sequence[str] = (), at: str = "eval_at") -> DataFrame:
    """Each series reduced to its last non-null value."""
    known = F.when(F.col(value).isNotNull(), F.col(at))
    return series.groupBy(*by).agg(F.max_by(value, known).alias(value))


def sorted_desc(series: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """A reduced series, largest first."""
    return series.orderBy(F.desc(value), *by)


def label_values(df: DataFrame, label: str) -> DataFrame:
    return df.select(label).distinct()


def labels(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every label name with its number of distinct values and of lines.

    The lines are first reduced to one row per combination of label values.
    """
    combos = df.groupBy(*names).agg(F.count("*").alias("_n"))
    pairs = combos.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).cast("string").alias("value")) for c in names])),
        "_n",
    )
    per_value = pairs.filter("col.value IS NOT NULL").groupBy("col.label", "col.value").agg(F.sum("_n").alias("_n"))
    return per_value.groupBy("label").agg(F.count("*").alias("values"), F.sum("_n").alias("lines"))


def timeline(df: DataFrame, bucket: str = "1 minute", by: Sequence[str] = ("service", "incident_type"), ts: str = "ts") -> DataFrame:
    """Rows per tumbling bucket and ``by`` values."""
    return (
        df.groupBy(F.window(ts, bucket).alias("_w"), *by)
        .agg(F.count("*").alias("count"))
        .select(F.col("_w.start").alias("bucket"), *by, "count")
    )


def series(
    df: DataFrame, columns: Sequence[str], bucket: str = "1 minute", by: Sequence[str] = ("service",), ts: str = "ts"
) -> DataFrame:
    """Average and maximum of each column per tumbling bucket and ``by`` values."""
    stats = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("avg", F.avg), ("max", F.max))]
    return (
        df.groupBy(F.window(ts, bucket).alias("_w"), *by)
        .agg(*stats)
        .select(F.col("_w.start").alias("bucket"), *by, *[f"{n}_{c}" for c in columns for n in ("avg", "max")])
    )


def exact_percentile(
    df: DataFrame, value: str, p: float, by: Sequence[str] = (), name: str = "percentile"
) -> DataFrame:
    """Exact linearly interpolated percentile of the non-null values, per ``by`` values.

    The built-in ``percentile`` gathers all distinct values of a group in one task. Here equal values are
    counted first, the counts are summed up in range-partitioned blocks, and only the one or two values
    around the percentile's rank are kept. Runs a job: see ``blocks``.
    """
    times = [c for c in by if isinstance(df.schema[c].dataType, T.TimestampType)]
    plain = df.withColumns({c: micros(c) for c in times}).filter(F.col(value).isNotNull())
    counted = plain.groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    ranked = running_total(counted, by, ["_v"], "_n", "_upto")
    sizes = ranked.groupBy(*by).agg(F.max("_upto").alias("_size")).checkpoint()  # one row per group
    if by:
        sized = ranked.join(broadcast_if_small(sizes), list(by))
    else:
        sized = ranked.withColumn("_size", F.lit(sizes.first()[0]).cast("bigint"))
    where = F.lit(p) * (F.col("_size") - 1)
    low, high = F.floor(where) + 1, F.ceil(where) + 1

    def holds(rank: Column) -> Column:
        return (F.col("_upto") - F.col("_n") < rank) & (rank <= F.col("_upto"))

    ends = sized.filter(holds(low) | holds(high)).groupBy(*by).agg(
        F.max(F.when(holds(low), F.col("_v"))).alias("_lo"),
        F.max(F.when(holds(high), F.col("_v"))).alias("_hi"),
        F.max(where - F.floor(where)).alias("_part"),
    )
    between = F.col("_lo") + F.col("_part") * (F.col("_hi") - F.col("_lo"))
    out = ends.select(*by, between.alias(name))
    return out.withColumns({c: micros_to_ts(c) for c in times})


# Size of a quantile sketch: about that many values are kept of any number.
SKETCH = 200


def rank_error(k: int = SKETCH) -> float:
    """How far the rank of a sketch's answer may lie from the wanted one, as a share of the rows, in 99 of 100 cases.

    Fixed values: the published error of this kind of sketch (KLL) for one-sided ranks. Merging does not add to it, and up to ``k`` values are
    kept exactly.
    """
    return 2.296 / k**0.9723


def percentile_sketches(df: DataFrame, value: str, bucket: str = "1 minute", by: Sequence[str] = ("service",), k: int = SKETCH, ts: str = "ts") -> DataFrame:
    """``bucket, by, sketch, n``: a sketch of the values of each tumbling bucket, to be stored and merged. Partial sketches are
    merged behind the shuffle, so a hot bucket sends one of bounded size per task. Null values and times are left out."""
    known = df.filter(F.col(value).isNotNull() & F.col(ts).isNotNull())
    grouped = known.groupBy(F.window(ts, bucket)["start"].alias("bucket"), *by)
    return grouped.agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"), F.count("*").alias("n"))


def merge_sketches(sketches: DataFrame, bucket: str, by: Sequence[str] = ("service",)) -> DataFrame:
    """Sketches of wider buckets, or of fewer ``by`` values, from those of narrower ones."""
    grouped = sketches.groupBy(F.window("bucket", bucket)["start"].alias("bucket"), *by)
    return grouped.agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))


def sketched_percentile(sketches: DataFrame, p: float, name: str = "percentile") -> DataFrame:
    """The percentile of each sketch: a value of the data whose rank is within ``rank_error`` of the wanted one."""
    return sketches.withColumn(name, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).drop("sketch")


def latency_percentile(
    df: DataFrame,
    value: str = "network_latency_ms",
    p: float = 0.95,
    bucket: str = "1 minute",
    by: Sequence[str] = ("service",),
    ts: str = "ts",
    exact: bool = True,
    k: int = SKETCH,
) -> DataFrame:
    """Percentile of a metric per tumbling bucket and ``by`` values, exact or from a sketch of bounded size (see ``rank_error``)."""
    if exact:
        placed = df.withColumn("bucket", F.window(ts, bucket)["start"])
        return exact_percentile(placed, value, p, ["bucket", *by])
    return sketched_percentile(percentile_sketches(df, value, bucket, by, k, ts), p).drop("n")


def action_status(results: DataFrame, at: str = "result_at") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(results per status, latest state per action, actions still pending)."""
    per_status = results.groupBy("status").agg(F.count("*").alias("results"))
    # At equal times a terminal status counts as later than PENDING_APPROVAL.
    rank = F.struct(F.col(at), (F.col("status") != "PENDING_APPROVAL").cast("int"))
    latest = results.groupBy("action_id").agg(F.max_by("status", rank).alias("status"), F.max(at).alias(at))
    return per_status, latest, latest.filter(F.col("status") == "PENDING_APPROVAL")


def tail(df: DataFrame, n: int = 100, ts: str = "ts", seq: str = "seq", **labels: str) -> DataFrame:
    """The newest ``n`` lines with the given labels, newest first."""
    out = df
    for name, value in labels.items():
        out = out.filter(F.col(name) == value)
    return out.orderBy(F.desc(ts), F.desc(seq)).limit(n)


def between_days(df: DataFrame, start: Column, end: Column | None = None, day: str = "dt") -> DataFrame:
    """Leaves out whole days of a written store; without a ``day`` column nothing."""
    if day not in df.columns:
        return df
    out = df.filter(F.col(day) >= F.to_date(start))
    return out if end is None else out.filter(F.col(day) <= F.to_date(end))


def query_range(
    df: DataFrame,
    start: datetime | str | Column,
    end: datetime | str | Column,
    limit: int = 20,
    direction: str = "backward",
    ts: str = "ts",
    seq: str = "seq",
    **labels: str,
) -> DataFrame:
    """Up to ``limit`` lines in [start, end] with the given labels, newest first unless ``direction="forward"``."""

    def moment(x: datetime | str | Column) -> Column:
        return x if isinstance(x, Column) else F.lit(x).cast("timestamp")

    out = between_days(df, moment(start), moment(end)).filter((F.col(ts) >= moment(start)) & (F.col(ts) <= moment(end)))
    for name, value in labels.items():
        out = out.filter(F.col(name) == value)
    turn = F.asc if direction == "forward" else F.desc
    return out.orderBy(turn(ts), turn(seq)).limit(limit)


def freshness(
    df: DataFrame, now: datetime | str | Column, seconds: int = 600, by: str = "topic", ts: str = "ts", known: Sequence[str] | None = None
) -> DataFrame:
    """Newest line per topic, and whether it is at most ``seconds`` old.

    With the topics that should be there (``known``), only the last ``seconds`` are read, which on a written store opens the last
    days alone; a topic without a line since then has a null ``newest`` and isn't fresh.
    """
    now = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    oldest = now - F.expr(f"INTERVAL {seconds} SECONDS")
    fresh = F.col("newest") >= oldest
    if known is not None:
        recent = between_days(df, oldest).filter(F.col(ts) >= oldest).groupBy(by).agg(F.max(ts).alias("newest"))
        names = df.sparkSession.createDataFrame([(k,) for k in known], f"{by} string")
        return names.join(recent, by, "left").withColumn("fresh", F.coalesce(fresh, F.lit(False)))
    return df.groupBy(by).agg(F.max(ts).alias("newest")).withColumn("fresh", fresh)
