"""The life of incidents while it happens: incidents, intents and results as three streams that are joined.

Each join is a left outer join of two streams with a bound on the time between their rows, so the state of both sides is dropped when
the watermark has passed that bound, and a row without a partner is given out then. Results meet their intents first, since an
incident without an action would have no time to wait by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.approvals import TERMINAL
from tidewatch.operators.lifecycle import LIFECYCLE, waiting_times


def _first(df: DataFrame, key: str, at: str, late: str, wanted: Column) -> DataFrame:
    """The first wanted row of each key; one that comes again within the lateness is dropped.

    Unwanted rows, too, tell how far the stream has come. The condition therefore has the time in it, or Spark would filter before
    it looks at the time.
    """
    kept = F.when(wanted & F.col(key).isNotNull(), F.col(at)).isNotNull()
    return df.withWatermark(at, late).filter(kept).dropDuplicatesWithinWatermark([key])


def _untimed(df: DataFrame, column: str) -> DataFrame:
    """The column as a plain time: behind a join, only the left side's time goes on as the stream's event time."""
    return df.withColumn(column, F.timestamp_micros(F.unix_micros(column)))


def lifecycle_stream(
    incidents: DataFrame,
    intents: DataFrame,
    results: DataFrame,
    horizon: str = "1 day",
    late: str = "10 minutes",
    ts: str = "ts",
    result_ts: str = "result_at",
) -> DataFrame:
    """The rows of ``operators.lifecycle.lifecycle`` for streams.

    An intent follows its incident, and a result its intent, within ``horizon``; a row is given out when its joins can gain nothing more.
    Rows later than ``late`` behind the slowest stream are dropped, and so are records that come again within it. Of several final
    results of one action the first to arrive counts.
    """
    span = F.expr(f"INTERVAL {horizon}")
    every = F.lit(True)
    opened = _first(incidents.select("incident_id", "service", "incident_type", F.col(ts).alias("incident_at")), "incident_id", "incident_at", late, every)
    acted = intents.select("action_id", "incident_id", "rule_id", "action_type", "target_service", F.col(ts).alias("intent_at"))
    acted = _first(acted, "action_id", "intent_at", late, every)

    def met(left: DataFrame, wanted: Column, at: str, status: str) -> DataFrame:
        found = results.select(F.col("action_id").alias("_action"), F.col(result_ts).alias(at), F.col("status").alias(status))
        right = _first(found, "_action", at, late, wanted)
        within = (F.col(at) >= F.col("intent_at")) & (F.col(at) <= F.col("intent_at") + span)
        return _untimed(left.join(right, (F.col("action_id") == F.col("_action")) & within, "left").drop("_action"), at)

    handled = met(acted, F.col("_pending") == "PENDING_APPROVAL", "pending_at", "_pending").drop("_pending")
    handled = met(handled, F.col("terminal_status").isin(*TERMINAL), "terminal_at", "terminal_status")
    handled = handled.withColumnRenamed("incident_id", "_incident")
    within = (F.col("intent_at") >= F.col("incident_at")) & (F.col("intent_at") <= F.col("incident_at") + span)
    out = opened.join(handled, (F.col("incident_id") == F.col("_incident")) & within, "left")
    return waiting_times(_untimed(out, "intent_at")).select(*LIFECYCLE)
