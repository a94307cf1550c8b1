"""The registered queries: every operator over whole test tables, with plain columns as result."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.scalars import iso_z, parse_ts
from tidewatch.operators import bursts as B
from tidewatch.operators import metrics as M
from tidewatch.operators import remediation as R
from tidewatch.operators import timeline as L
from tidewatch.operators.approvals import route_actions
from tidewatch.operators.forest import ForestModel, fit_forest
from tidewatch.operators.lifecycle import lifecycle, match_by_keys, missing
from tidewatch.operators.logs import log_incidents, normalize_logs
from tidewatch.plans import event_views as V
from tidewatch.plans.pipeline import Limits, candidates_of, incidents_of, intents_of, log_incident_stream, results_of
from tidewatch.schemas import LOGS_RAW, STORED_TOPICS
from tidewatch.session import ROCKSDB_PROVIDER, scratch_path
from tidewatch.sources import logstore as S
from tidewatch.sources import topics as T
from tidewatch.sources.rulebook import load_rules
from tidewatch.streaming import sinks
from tidewatch.streaming.counts import count_sink, read_counts, write_batch_counts
from tidewatch.streaming.lifecycle import lifecycle_stream
from tidewatch.streaming.operators import detect_bursts_stream, resolve_approvals_stream, rolling_stats_stream
from tidewatch.streaming.partitions import few_partitions, state_partitions

# Limits at which the test events, one per second, give incidents of every kind.
LIMITS = Limits(window_sec=30, burst=4, cpu=55, mem=65, lat=100)
AS_OF = 4_000_000_000


def r9(c: str) -> Column:
    return F.round(F.col(c), 9).alias(c)


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_logs(V.logs_raw(spark, sf))


def enriched(spark: SparkSession, sf: str, by: str | None = None) -> DataFrame:
    return M.enrich_metrics(V.metrics_raw(spark, sf), by=by)


def anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return M.type_anomalies(V.flag_by_limits(enriched(spark, sf)), LIMITS.cpu, LIMITS.mem, LIMITS.lat)


def plain_spikes(spark: SparkSession, sf: str) -> DataFrame:
    """Bursts and anomalies as incidents; anomalies bring their own id."""
    bursts, _, _ = log_incident_stream(parsed(spark, sf), LIMITS)
    flagged = M.anomaly_incidents(anomalies(spark, sf))
    flagged = flagged.withColumn("incident_id", F.concat(F.lit("anomaly-"), F.col("seq").cast("string")))
    return bursts.unionByName(flagged, allowMissingColumns=True)


def spikes(spark: SparkSession, sf: str) -> DataFrame:
    """The same in the spellings of their producers."""
    return plain_spikes(spark, sf).withColumns({"service": V.spelled_service(), "severity": V.spelled_severity()})


def outcomes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(incidents, intents, results) with approvals required. Incidents and intents are written once, like topics."""
    incidents = R.with_incident_id(plain_spikes(spark, sf)).checkpoint()
    intents = intents_of(incidents, load_rules(spark), require_approval=True).checkpoint()
    return incidents, intents, results_of(intents, V.approvals_of(intents), as_of=AS_OF)


def store(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines of parsed logs, raw metrics with flags, and keyword incidents: topics that need no ordered pass."""
    logs = parsed(spark, sf)
    metrics = M.finish_metrics(M.prepare_metrics(V.metrics_raw(spark, sf)))
    frames = {"logs_parsed": logs, "metrics_enriched": metrics, "incidents": log_incidents(logs)}
    return S.log_lines(frames, now=F.lit("2024-02-01 00:00:00").cast("timestamp"))


# Logs and incidents


def normalize(spark, sf):
    return parsed(spark, sf).drop("ts")


def keyword_incidents(spark, sf):
    return log_incidents(parsed(spark, sf)).drop("ts")


def incident_timeline(spark, sf):
    out = L.timeline(log_incidents(parsed(spark, sf)))
    return out.withColumn("bucket", iso_z("bucket"))


def error_window_counts(spark, sf):
    errors = B.error_logs(parsed(spark, sf))
    return B.trailing_count(errors, 30).select("seq", "service", "trailing_count")


def error_window_counts_redelivered(spark, sf):
    """Every 7th record comes twice, every 11th has no time."""
    errors = parsed(spark, sf).filter(F.col("severity").isin("error", "critical"))
    errors = errors.withColumn("ts", F.when(F.col("seq") % 11 != 0, F.col("ts")))
    twice = errors.unionByName(errors.filter(F.col("seq") % 7 == 0))
    return B.trailing_count(twice, 30).select("seq", "service", "trailing_count")


def error_bursts(spark, sf):
    out, _, _ = log_incident_stream(parsed(spark, sf), LIMITS)
    return out.drop("ts")


def every_incident(spark, sf):
    def flag(df):
        return V.flag_by_limits(df)

    out = incidents_of(V.logs_raw(spark, sf), V.metrics_raw(spark, sf), flag, LIMITS)
    return out.select("seq", "timestamp", "service", "severity", "incident_type", "source")


# Metrics and anomalies

_ENRICHED = (
    "seq", "timestamp", "service", "severity", "cpu_percent", "memory_percent", "network_latency_ms",
    "is_high_cpu", "is_high_memory", "is_high_latency", "cpu_to_memory_ratio",
)


def enrich_global(spark, sf):
    return enriched(spark, sf).select(*_ENRICHED, *[r9(c) for c in M.FEATURES])


def enrich_by_service(spark, sf):
    return enriched(spark, sf, by="service").select(*_ENRICHED, *[r9(c) for c in M.FEATURES])


def rolling_extremes(spark, sf):
    out = M.rolling_stats(M.prepare_metrics(V.metrics_raw(spark, sf)), by="service", stats=("max", "min", "size"))
    return out.select("seq", "service", *[f"{m}_{s}_5" for m in ("cpu", "memory", "latency") for s in ("max", "min", "size")])


def anomaly_features(spark, sf):
    out = M.features(enriched(spark, sf))
    return out.select("seq", *[F.round(F.col("features")[i], 9).alias(f"feature_{i}") for i in range(3)])


def anomaly_types(spark, sf):
    return anomalies(spark, sf).select(
        "seq", "timestamp", "service", "severity", "anomaly_type", "is_anomaly", r9("anomaly_score")
    )


def anomaly_incident_records(spark, sf):
    out = M.anomaly_incidents(anomalies(spark, sf))
    typed = F.get_json_object("details", "$.anomaly.anomaly_type").alias("detail_type")
    return out.select("seq", "timestamp", "service", "severity", "incident_type", "source", typed)


def p95_latency(spark, sf):
    out = L.latency_percentile(V.metrics_raw(spark, sf), bucket="10 minutes")
    return out.select(iso_z("bucket").alias("bucket"), "service", F.round("percentile", 9).alias("p95"))


def p95_latency_sketched(spark, sf):
    """Sketches per minute, merged to hours; the rank of each answer in the data is held against the stated error."""
    raw = V.metrics_raw(spark, sf)
    hours = L.merge_sketches(L.percentile_sketches(raw, "network_latency_ms"), "1 hour").checkpoint()
    answers = L.sketched_percentile(hours, 0.95)
    placed = raw.filter("network_latency_ms IS NOT NULL").withColumn("bucket", F.window("ts", "1 hour")["start"])
    met = placed.join(answers, ["bucket", "service"]).groupBy("bucket", "service", "n", "percentile")
    ranks = met.agg(F.count(F.when(F.col("network_latency_ms") < F.col("percentile"), 1)).alias("below"), F.count(F.when(F.col("network_latency_ms") <= F.col("percentile"), 1)).alias("upto"))
    # Twice the error that 99 of 100 answers keep.
    error = 2 * L.rank_error()
    close = (F.col("below") / F.col("n") <= 0.95 + error) & (F.col("upto") / F.col("n") >= 0.95 - error)
    return ranks.select(iso_z("bucket").alias("bucket"), "service", "n", close.alias("close"))


def metric_series(spark, sf):
    out = L.series(V.metrics_raw(spark, sf), ["cpu_percent", "memory_percent"])
    names = [c for c in out.columns if c not in ("bucket", "service")]
    return out.select(iso_z("bucket").alias("bucket"), "service", *[r9(c) for c in names])


def anomaly_score_series(spark, sf):
    out = L.series(anomalies(spark, sf), ["anomaly_score"], bucket="5 minutes")
    return out.select(iso_z("bucket").alias("bucket"), "service", r9("avg_anomaly_score"), r9("max_anomaly_score"))


def forest_scores(spark, sf):
    metrics = enriched(spark, sf)
    model = fit_forest(metrics, M.FEATURES, seq="seq", seed=42)
    scored = M.type_anomalies(model.score(metrics))
    return scored.select("seq", "service", "severity", "anomaly_type", r9("anomaly_score"), "is_anomaly")


def forest_fixed_scores(spark, sf):
    """A forest of two written-out trees."""
    columns = ["tree_id", "node_id", "feature", "threshold", "left", "right", "size", "depth"]
    nodes = [
        (0, 0, 0, 50.0, 1, 2, 256, 0), (0, 1, -1, 0.0, -1, -1, 200, 1), (0, 2, 2, 90.0, 3, 4, 56, 1),
        (0, 3, -1, 0.0, -1, -1, 55, 2), (0, 4, -1, 0.0, -1, -1, 1, 2),
        (1, 0, 1, 40.0, 1, 2, 256, 0), (1, 1, -1, 0.0, -1, -1, 2, 1), (1, 2, -1, 0.0, -1, -1, 254, 1),
    ]
    model = ForestModel(pd.DataFrame(nodes, columns=columns), M.FEATURES, 256, -0.5)
    return model.score(enriched(spark, sf)).select("seq", r9("anomaly_score"), "is_anomaly")


def forest_fit_summary(spark, sf):
    """What any fit must have: all trees, full samples, bounded depth, and the wanted share below 0."""
    metrics = enriched(spark, sf)
    model = fit_forest(metrics, M.FEATURES, seq="seq", seed=42)
    roots = model.nodes[model.nodes.node_id == 0]
    scored = model.score(metrics).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_anomaly").cast("long")).alias("flagged"))
    return scored.select(
        F.lit(len(roots)).alias("trees"),
        F.lit(int(roots["size"].min())).alias("smallest_root"),
        F.lit(int(roots["size"].max())).alias("largest_root"),
        F.lit(bool(model.nodes.depth.max() <= 8)).alias("depth_bounded"),
        (F.abs(F.col("flagged") / F.col("n") - 0.05) <= 0.01).alias("share_flagged"),
    )


# Remediation


def canonical_incidents(spark, sf):
    raw = log_incidents(parsed(spark, sf))
    spelled = raw.withColumns({"service": V.spelled_service(), "severity": V.spelled_severity()})
    out = R.canonicalize_incidents(spelled.withColumn("target", F.upper("service")), load_rules(spark).aliases)
    return out.select(
        "seq", "service", "severity", "target", "incident_type",
        F.col("_service_alias_raw").alias("alias_raw"), F.col("_service_alias_canonical").alias("alias_canonical"),
    )


def rule_candidates(spark, sf):
    book = load_rules(spark)
    known = R.canonicalize_incidents(spikes(spark, sf), book.aliases)
    out = R.match_rules(known, book.rules, book.default_severity, book.prefixes)
    return out.select("seq", "incident_type", "service", "severity", "rule_id", "action_type", "target_service", "cooldown_sec")


def policy_decisions(spark, sf):
    book = load_rules(spark)
    known = R.canonicalize_incidents(spikes(spark, sf), book.aliases)
    allowed, rejected = R.apply_policy(R.match_rules(known, book.rules, book.default_severity, book.prefixes), book.policy)
    both = allowed.withColumn("reason", F.lit("allowed")).unionByName(rejected)
    return both.select("seq", "rule_id", "action_type", "target_service", "reason")


_GLOBS = {
    "rules": [
        {"rule_id": "any_letter", "incident_type": "AUTH_FAILURE", "pattern": "?b", "action_type": "SCALE_UP"},
        {"rule_id": "set", "incident_type": "DB_LATENCY", "pattern": "[op]*", "action_type": "REBOOT"},
        {"rule_id": "other_set", "incident_type": "REQUEST_TIMEOUT", "pattern": "[!a]*s", "action_type": "ROLLING_RESTART"},
    ],
    "policy": {"allowlist_services": ["payments", "db"], "allowlist_action_types": ["SCALE_UP", "ROLLING_RESTART"]},
}


def glob_decisions(spark, sf):
    """Rules for some services only, and an action type that is not allowed."""
    book = load_rules(spark, _GLOBS)
    known = R.canonicalize_incidents(log_incidents(parsed(spark, sf)), book.aliases)
    allowed, rejected = R.apply_policy(R.match_rules(known, book.rules, book.default_severity, book.prefixes), book.policy)
    both = allowed.withColumn("reason", F.lit("allowed")).unionByName(rejected)
    return both.select("seq", "rule_id", "action_type", "target_service", "reason")


_SERVICE_RULES = {
    "rules": [
        {"rule_id": f"{kind.lower()}-{pattern}", "incident_type": kind, "pattern": pattern, "action_type": "SCALE_UP", "cooldown_sec": n}
        for kind in ("AUTH_FAILURE", "DB_LATENCY", "REQUEST_TIMEOUT", "CACHE_STORM")
        for n, pattern in enumerate(("*", "pay*", "payments", "payments?", "o*s", "orders*", "au[st]h", "auth-*", "d", "db", "db*", "x*", "payments-with-a-long-name*"))
    ]
}


def service_rules(spark, sf):
    """Rules filed under the beginnings of service names."""
    book = load_rules(spark, _SERVICE_RULES)
    known = R.canonicalize_incidents(log_incidents(parsed(spark, sf)), book.aliases)
    out = R.match_rules(known, book.rules, book.default_severity, book.prefixes)
    return out.select("seq", "service", "rule_id", "cooldown_sec")


def action_intents(spark, sf):
    allowed, _ = candidates_of(spikes(spark, sf), load_rules(spark))
    out = R.to_intents(allowed)
    return out.select(
        "seq", "event_type", "timestamp", "service", "severity", "incident_id", "correlation_id", "action_id",
        "rule_id", "status", "action_type", "target_service", "parameters", "source",
    )


def intents_after_cooldown(spark, sf):
    out = intents_of(spikes(spark, sf), load_rules(spark))
    return out.select("seq", "rule_id", "target_service", "action_id", "status")


def ttl_dedup(spark, sf):
    actions = V.events(spark, sf).select(F.concat(F.lit("action-"), F.col("user_id")).alias("action_id"), "ts", "seq")
    return R.dedup_ttl(actions).select("action_id", "seq")


def approval_results(spark, sf):
    _, _, results = outcomes(spark, sf)
    return results.select(
        "event_type", "action_id", "action_type", "target_service", "status", "message", "ts", "incident_id",
        "rule_id", "executed_action", "approver",
    )


def approval_repeats(spark, sf):
    """Intents that come again, 300 s and 2000 s later, some of them for an action nobody supports, with the approvals of the first ones."""
    incidents = R.with_incident_id(plain_spikes(spark, sf)).checkpoint()
    first = intents_of(incidents, load_rules(spark), require_approval=True).checkpoint()
    third, fourth = F.substring("action_id", 3, 1), F.substring("action_id", 4, 1)
    first = first.withColumn("action_type", F.when(third.between("0", "3"), "REBOOT").otherwise(F.col("action_type")))

    def again(seconds: int, low: str, high: str) -> DataFrame:
        later = F.timestamp_seconds(F.unix_seconds("ts") + seconds)
        return first.filter(fourth.between(low, high)).withColumns({"ts": later, "seq": F.col("seq") + seconds * 1_000_000})

    intents = first.unionByName(again(300, "0", "9")).unionByName(again(2000, "5", "d"))
    results = results_of(intents, V.approvals_of(first), as_of=AS_OF)
    return results.select("action_id", "action_type", "status", "message", "ts", "executed_action", "approver")


def remediation_lifecycle(spark, sf):
    incidents, intents, results = outcomes(spark, sf)
    out = lifecycle(incidents, intents, results)
    return out.select(
        "incident_id", "service", "incident_type", "rule_id", "terminal_status", "sec_to_intent", "sec_to_terminal"
    )


def action_status(spark, sf):
    _, _, results = outcomes(spark, sf)
    per_status, latest, _ = L.action_status(results)
    by_state = latest.groupBy("status").agg(F.count("*").alias("actions"))
    return per_status.join(by_state, "status", "left").select("status", "results", F.coalesce("actions", F.lit(0)).alias("actions"))


def routed_actions(spark, sf):
    """All three kinds of records on one topic, written out, read back and routed."""
    _, intents, results = outcomes(spark, sf)
    path = scratch_path(spark, "actions")
    for frame in (intents.drop("ts"), V.approvals_of(intents).withColumn("ts", iso_z("ts")), results.drop("result_at")):
        T.write_topic(frame, "actions", path=path)
    asked, answered = route_actions(T.read_topic(spark, "actions", path=path))
    counted = [df.groupBy("event_type", "status", "decision").agg(F.count("*").alias("records")) for df in (asked, answered)]
    return counted[0].unionByName(counted[1])


def fallback_match(spark, sf):
    user = F.col("user_id").cast("string")
    way = F.col("k") % 5
    test, incident = F.concat(F.lit("test-"), user), F.concat(F.lit("incident-"), user)
    embedded = (
        F.when(way == 1, F.to_json(F.struct(incident.alias("incident_id"))))
        .when(way == 2, F.to_json(F.struct(test.alias("test_id"))))
    )
    left = V.events(spark, sf).select(
        "seq",
        F.when(way == 0, incident).alias("incident_id"),
        F.get_json_object(embedded, "$.incident_id").alias("embedded_incident_id"),
        F.get_json_object(embedded, "$.test_id").alias("embedded_test_id"),
        F.when(way == 3, test).alias("test_id"),
    )
    right = V.events(spark, sf).select(incident.alias("incident_id"), test.alias("test_id")).distinct()
    pairs = [
        ("incident_id", "incident_id"),
        ("embedded_incident_id", "incident_id"),
        ("embedded_test_id", "test_id"),
        ("test_id", "test_id"),
    ]
    out = match_by_keys(left, right, pairs, "seq", "incident_id", "matched")
    return out.select("seq", "matched", "matched_by")


# Log store and dashboards


def log_line_records(spark, sf):
    _, intents, results = outcomes(spark, sf)
    logs = parsed(spark, sf)
    typed = anomalies(spark, sf)
    frames = {
        "logs_parsed": logs,
        "metrics_enriched": enriched(spark, sf),
        "ml_output": typed,
        "incidents": M.anomaly_incidents(typed),
        "actions": intents.unionByName(results.drop("ts", "result_at"), allowMissingColumns=True),
    }
    out = S.log_lines(frames, now=F.lit("2024-02-01 00:00:00").cast("timestamp"))
    text = F.when(F.col("topic") == "logs_parsed", F.col("message"))
    service = F.get_json_object("message", "$.service")
    return (
        out.withColumns({"text": text, "message_service": service})
        .groupBy("source", "topic", "service", "severity", "text", "message_service")
        .agg(F.count("*").alias("lines"))
    )


def log_store_round_trip(spark, sf):
    path = scratch_path(spark, "log_store")
    S.write_log_store(store(spark, sf), path)
    out = S.select_logs(S.read_log_store(spark, path), topic="incidents", severity="error")
    return out.select("source", "topic", "service", "severity", "timestamp", "seq", F.col("dt").cast("string").alias("dt"))


def select_logs(spark, sf):
    out = S.select_logs(store(spark, sf), source="ops", service="payments", severity="error")
    return out.select("topic", "service", "severity", "timestamp", "seq")


def json_filter(spark, sf):
    fields = {"kind": "$.incident_type", "trace_id": "$.trace_id"}
    out = S.select_logs(store(spark, sf), json_fields=fields, where="kind = 'AUTH_FAILURE'", source="ops")
    return out.select("topic", "service", "severity", "kind", "seq")


def json_fields(spark, sf):
    """Fields of the whole record, also where the line shows its message alone."""
    fields = {"trace_id": "$.trace_id", "original_level": "$.original_level", "severity": "$.level"}
    out = S.select_logs(store(spark, sf), json_fields=fields, topic="logs_parsed")
    return out.select("seq", "severity", "message", "trace_id", "original_level")


def tail_of_store(spark, sf):
    """The newest lines of a written store, by days."""
    path = scratch_path(spark, "tail-store")
    S.write_log_store(store(spark, sf), path)
    return S.tail_store(spark, path, 100, topic="logs_parsed", severity="error").select("topic", "service", "severity", "message", "timestamp", "seq")


def store_retention(spark, sf):
    """A store by the events' own days, from which old lines are dropped where it lies, twice."""
    path = scratch_path(spark, "old-store")
    own = V.events(spark, sf).select("seq", iso_z("happened_at").alias("timestamp"))
    logs = parsed(spark, sf).drop("timestamp").join(own, "seq")
    S.write_log_store(S.log_lines({"logs_parsed": logs}, now=F.lit("2024-02-01 00:00:00").cast("timestamp")), path)
    for _ in range(2):
        S.retain_log_store(spark, path, "2024-01-15 12:00:00")
    return S.read_log_store(spark, path).select("seq", "severity", "timestamp", F.col("dt").cast("string").alias("dt"))


def tail_errors(spark, sf):
    out = L.tail(store(spark, sf), 100, topic="logs_parsed", severity="error")
    return out.select("topic", "service", "severity", "message", "timestamp", "seq")


def range_query(spark, sf):
    lines = store(spark, sf)
    out = L.query_range(lines, "2024-01-01 00:05:00", "2024-01-01 00:15:00", 20, topic="logs_parsed", source="ops")
    return out.select("service", "severity", "message", "timestamp", "seq")


def freshness(spark, sf):
    out = L.freshness(store(spark, sf), "2024-01-01 02:50:00")
    return out.select("topic", iso_z("newest").alias("newest"), "fresh")


def missing_topics(spark, sf):
    required = spark.createDataFrame([(t,) for t in (*STORED_TOPICS, "logs_raw", "metrics_raw")], "topic string")
    return missing(required, store(spark, sf), "topic")


def incident_count_1m(spark, sf):
    out = L.count_over_time(S.select_logs(store(spark, sf), source="ops", topic="incidents"), 60, 30)
    return out.withColumn("eval_at", iso_z("eval_at"))


def incident_count_last(spark, sf):
    out = L.count_over_time(S.select_logs(store(spark, sf), source="ops", topic="incidents"), 60, 30, by=["service"])
    return L.last_value(out, "count", ["service"])


def error_count_1m(spark, sf):
    out = L.count_over_time(S.select_logs(store(spark, sf), source="ops", severity="error"), 60, 60)
    return out.withColumn("eval_at", iso_z("eval_at"))


def error_rate_by_service(spark, sf):
    out = L.rate(S.select_logs(store(spark, sf), source="ops", severity="error"), 300, 60, ["service"])
    return out.select(iso_z("eval_at").alias("eval_at"), "service", r9("rate"))


def severity_distribution(spark, sf):
    out = L.count_over_time(S.select_logs(store(spark, sf), source="ops"), 300, 60, ["severity"])
    return L.sorted_desc(L.last_value(out, "count", ["severity"]), "count", ["severity"])


def label_values(spark, sf):
    lines = S.select_logs(store(spark, sf), source="ops")
    out = None
    for name in ("service", "severity", "topic"):
        found = L.label_values(lines, name).select(F.lit(name).alias("label"), F.col(name).alias("value"))
        out = found if out is None else out.unionByName(found)
    return out


def labels(spark, sf):
    return L.labels(store(spark, sf), S.LABELS)


def retention(spark, sf):
    events = V.events(spark, sf).withColumn("dt", F.to_date("happened_at"))
    out = S.apply_retention(events, "2024-01-15 12:00:00", ts="happened_at")
    return out.select("seq", F.col("dt").cast("string").alias("dt"))


# Topics


def parse_timestamps(spark, sf):
    way, at = F.col("seq") % 5, F.col("ts")
    text = (
        F.when(way == 0, iso_z(at))
        .when(way == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
        .when(way == 2, F.unix_millis(at).cast("string"))
        .when(way == 3, F.unix_seconds(at).cast("string"))
        .otherwise("not a time")
    )
    out = V.events(spark, sf).withColumn("text", text)
    return out.select("seq", "text", F.unix_micros(parse_ts("text")).alias("micros"))


def topic_round_trip(spark, sf):
    path = scratch_path(spark, "logs_raw")
    raw = V.logs_raw(spark, sf).drop("ts", "seq")
    T.write_topic(raw, "logs_raw", path=path)
    good, _ = T.split_malformed(T.read_topic(spark, "logs_raw", path=path))
    return good


def malformed_split(spark, sf):
    raw = V.logs_raw(spark, sf)
    way = F.col("seq") % 7
    value = (
        F.when(way == 0, F.concat(F.lit("not json "), F.col("seq").cast("string")))
        .when(way == 1, "")
        .otherwise(F.to_json(F.struct("timestamp", "service", "level", "message", "trace_id")))
    )
    good, bad = T.split_malformed(T.parse_values(raw.select(value.alias("value")), LOGS_RAW))
    kept = good.select(F.lit("good").alias("kind"), F.coalesce("trace_id", F.lit("empty")).alias("body"))
    both = kept.unionByName(bad.select(F.lit("bad").alias("kind"), F.col("value").alias("body")))
    return both.groupBy("kind", "body").agg(F.count("*").alias("records"))


# Streams over the same tables, run to the end of what is there


def _folders(spark: SparkSession, name: str) -> list[str]:
    root = scratch_path(spark, name)
    return [f"{root}/{part}" for part in ("out", "carry", "checkpoint")]


def stream_enrich_global(spark, sf):
    out, carry, checkpoint = _folders(spark, "enrich")
    raw = _in_order(spark, V.metrics_raw(spark, sf), "metrics_raw")
    sinks.rolling_sink(raw, out, carry, checkpoint).awaitTermination()
    return spark.read.parquet(f"{out}/batch=*").select(*_ENRICHED, *[r9(c) for c in M.FEATURES])


def stream_bursts(spark, sf):
    out, carry, checkpoint = _folders(spark, "bursts")
    logs = normalize_logs(_in_order(spark, V.logs_raw(spark, sf), "logs_raw"))
    sinks.burst_sink(logs, out, carry, checkpoint, LIMITS.window_sec, LIMITS.burst).awaitTermination()
    return spark.read.parquet(f"{out}/batch=*").drop("ts")


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A table written out and read back, for what is read several times and costly to compute."""
    path = scratch_path(spark, f"{name}-whole")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _in_order(spark: SparkSession, df: DataFrame, name: str, parts: int = 5, by: str | Column = "seq", end: DataFrame | None = None) -> DataFrame:
    """A table written out by ranges of ``by`` and read back as a stream that takes one range per micro-batch, ``end`` last."""
    df, path = _written(spark, df, name), scratch_path(spark, name)
    files = state_partitions(spark)
    place = F.col(by) if isinstance(by, str) else by
    low, high = df.agg(F.min(place), F.max(place)).first()
    for i in range(parts):
        width = ((high or 0) - (low or 0)) // parts + 1
        df.filter(F.floor((place - F.lit(low or 0)) / width) == i).repartition(files).write.mode("append").parquet(path)
    if end is not None:
        end.select(*df.columns).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def _run(df: DataFrame, out: str, checkpoint: str) -> None:
    writer = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    with few_partitions(df.sparkSession):
        query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def stream_enrich_by_service(spark, sf):
    """Keyed state, one window per service."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    out, _, checkpoint = _folders(spark, "enrich-keyed")
    _run(rolling_stats_stream(_in_order(spark, V.metrics_raw(spark, sf), "metrics_raw")), out, checkpoint)
    return spark.read.parquet(out).select(*_ENRICHED, *[r9(c) for c in M.FEATURES])


def stream_bursts_keyed(spark, sf):
    """Keyed state, one detector per service."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    out, _, checkpoint = _folders(spark, "bursts-keyed")
    logs = normalize_logs(_in_order(spark, V.logs_raw(spark, sf), "logs_raw"))
    _run(detect_bursts_stream(logs, LIMITS.window_sec, LIMITS.burst), out, checkpoint)
    return spark.read.parquet(out).drop("ts")


def _as_stream(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A table written out and read back as a stream of its files."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def stream_error_count(spark, sf):
    """Counts kept up to date by a stream of log lines, asked for a range of one minute; the second batch is delivered twice."""
    table, _, checkpoint = _folders(spark, "counts")
    lines = _written(spark, S.select_logs(store(spark, sf), source="ops", severity="error").select("ts", "seq"), "lines")
    count_sink(_in_order(spark, lines, "error-lines"), table, checkpoint).awaitTermination()
    low, high = lines.agg(F.min("seq"), F.max("seq")).first()
    width = ((high or 0) - (low or 0)) // 5 + 1
    write_batch_counts(lines.filter(F.floor((F.col("seq") - F.lit(low or 0)) / width) == 1), 1, table, 60, [])
    out = L.count_over_buckets(read_counts(spark, table, []), 60, 60, 60)
    return out.withColumn("eval_at", iso_z("eval_at"))


def two_topics(spark, sf):
    """Parsed logs and model output in one read, each typed by its own layout."""
    root = scratch_path(spark, "topics")
    logs = parsed(spark, sf).drop("ts", "seq")
    scores = anomalies(spark, sf).drop("ts", "seq")
    T.write_topic(logs, "logs_parsed", path=f"{root}/logs_parsed")
    T.write_topic(scores, "ml_output", path=f"{root}/ml_output")
    read = T.read_topics(spark, ["logs_parsed", "ml_output"], paths={n: f"{root}/{n}" for n in ("logs_parsed", "ml_output")})
    names = {"logs_parsed": "severity", "ml_output": "anomaly_type"}
    out = None
    for topic, kind in names.items():
        good, _ = T.split_malformed(read[topic])
        found = good.select("topic", "service", F.col(kind).alias("kind"), "timestamp")
        out = found if out is None else out.unionByName(found)
    return out


def stream_restart(spark, sf):
    """A topic followed from its end over a restart: files that were there before are left out, those that came meanwhile are not."""
    source, target = scratch_path(spark, "followed"), scratch_path(spark, "delivered")
    checkpoint = scratch_path(spark, "follow-checkpoint")
    raw = V.logs_raw(spark, sf).withColumn("part", F.col("seq") % 4)

    def come(part: int) -> None:
        T.write_topic(raw.filter(F.col("part") == part).drop("part", "ts", "seq"), "logs_raw", path=source)

    def follow() -> None:
        rows = T.read_topic(spark, "logs_raw", path=source, start="latest", stream=True, checkpoint=checkpoint).drop("_malformed", "topic")
        sinks.write_topic_stream(rows, "followed", checkpoint, path=target).awaitTermination()

    come(0)
    follow()
    for part in (1, 2):
        come(part)
    follow()
    come(3)
    follow()
    good, _ = T.split_malformed(T.read_topic(spark, "logs_raw", path=target))
    return good


def stream_cooldown(spark, sf):
    allowed, _ = candidates_of(spikes(spark, sf), load_rules(spark))
    out, carry, checkpoint = _folders(spark, "cooldown")
    sinks.cooldown_sink(_in_order(spark, allowed.checkpoint(), "candidates"), out, carry, checkpoint).awaitTermination()
    emitted = R.to_intents(spark.read.parquet(f"{out}/batch=*"))
    return emitted.select("seq", "rule_id", "target_service", "action_id", "status")


def stream_approvals(spark, sf):
    """Only what the end of the stream has reached can expire."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    intents = intents_of(plain_spikes(spark, sf), load_rules(spark), require_approval=True).checkpoint()
    asked = _as_stream(spark, intents, "intents")
    answered = _as_stream(spark, V.approvals_of(intents), "approvals")
    out, _, checkpoint = _folders(spark, "results")
    results = resolve_approvals_stream(asked, answered).drop("result_at")
    _run(results, out, checkpoint)
    return spark.read.parquet(out).select(
        "event_type", "action_id", "action_type", "target_service", "status", "message", "ts", "incident_id",
        "rule_id", "executed_action", "approver",
    )


def stream_lifecycle(spark, sf):
    """Incidents, intents and results as three streams. A last record of each, much later, lets all bounds pass."""
    incidents, intents, results = outcomes(spark, sf)
    end = spark.range(1).select(*[F.lit("end").alias(c) for c in ("incident_id", "action_id", "status")], (F.lit(V.CLOCK_START) + 10**8).cast("timestamp").alias("ts"))

    def stream(df: DataFrame, name: str, at: str, columns: list[str]) -> DataFrame:
        last = end.withColumnRenamed("ts", at)
        last = last.select(*[c if c in last.columns else F.lit(None).cast("string").alias(c) for c in columns])
        return _in_order(spark, df.select(*columns), name, by=F.unix_seconds(at), end=last)

    asked = stream(intents, "intents", "ts", ["action_id", "incident_id", "rule_id", "action_type", "target_service", "ts"])
    opened = stream(incidents, "incidents", "ts", ["incident_id", "service", "incident_type", "ts"])
    ended = stream(results, "results", "result_at", ["action_id", "status", "result_at"])
    out, _, checkpoint = _folders(spark, "lifecycle")
    _run(lifecycle_stream(opened, asked, ended, horizon="1 hour"), out, checkpoint)
    return spark.read.parquet(out).filter("incident_id <> 'end'").select(
        "incident_id", "service", "incident_type", "rule_id", "terminal_status", "sec_to_intent", "sec_to_terminal"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_logs": normalize,
    "keyword_incidents": keyword_incidents,
    "incident_timeline": incident_timeline,
    "enrich_metrics_global": enrich_global,
    "enrich_metrics_by_service": enrich_by_service,
    "rolling_extremes": rolling_extremes,
    "anomaly_features": anomaly_features,
    "anomaly_types": anomaly_types,
    "anomaly_incidents": anomaly_incident_records,
    "error_window_counts": error_window_counts,
    "error_window_counts_redelivered": error_window_counts_redelivered,
    "error_bursts": error_bursts,
    "all_incidents": every_incident,
    "canonical_incidents": canonical_incidents,
    "rule_candidates": rule_candidates,
    "policy_decisions": policy_decisions,
    "glob_decisions": glob_decisions,
    "service_rules": service_rules,
    "action_intents": action_intents,
    "intents_after_cooldown": intents_after_cooldown,
    "ttl_dedup": ttl_dedup,
    "approval_results": approval_results,
    "approval_repeats": approval_repeats,
    "remediation_lifecycle": remediation_lifecycle,
    "action_status": action_status,
    "routed_actions": routed_actions,
    "fallback_match": fallback_match,
    "missing_topics": missing_topics,
    "log_lines": log_line_records,
    "log_store_round_trip": log_store_round_trip,
    "select_logs": select_logs,
    "json_filter": json_filter,
    "json_fields": json_fields,
    "tail_errors": tail_errors,
    "tail_of_store": tail_of_store,
    "store_retention": store_retention,
    "range_query": range_query,
    "freshness": freshness,
    "incident_count_1m": incident_count_1m,
    "incident_count_last": incident_count_last,
    "error_count_1m": error_count_1m,
    "error_rate_by_service": error_rate_by_service,
    "severity_distribution": severity_distribution,
    "label_values": label_values,
    "labels": labels,
    "p95_latency": p95_latency,
    "p95_latency_sketched": p95_latency_sketched,
    "metric_series": metric_series,
    "anomaly_score_series": anomaly_score_series,
    "retention": retention,
    "parse_timestamps": parse_timestamps,
    "topic_round_trip": topic_round_trip,
    "malformed_split": malformed_split,
    "forest_scores": forest_scores,
    "forest_fixed_scores": forest_fixed_scores,
    "forest_fit_summary": forest_fit_summary,
    "stream_enrich_global": stream_enrich_global,
    "stream_bursts": stream_bursts,
    "stream_enrich_by_service": stream_enrich_by_service,
    "stream_bursts_keyed": stream_bursts_keyed,
    "stream_cooldown": stream_cooldown,
    "stream_approvals": stream_approvals,
    "stream_lifecycle": stream_lifecycle,
    "stream_error_count": stream_error_count,
    "stream_restart": stream_restart,
    "two_topics": two_topics,
}
