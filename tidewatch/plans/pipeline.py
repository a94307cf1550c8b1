"""End-to-end plans: raw records to incidents, incidents to intents, intents to results."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from tidewatch.operators.approvals import resolve_approvals
from tidewatch.operators.bursts import all_incidents, burst_fires, detect_bursts, fires_whole
from tidewatch.operators.logs import log_incidents, normalize_logs
from tidewatch.operators.metrics import anomaly_incidents, enrich_metrics, type_anomalies
from tidewatch.operators.remediation import (
    apply_cooldown,
    apply_policy,
    canonicalize_incidents,
    match_rules,
    to_intents,
    with_action_id,
    with_incident_id,
)
from tidewatch.session import shared_dir
from tidewatch.sources.rulebook import RuleBook


class Limits(NamedTuple):
    """Thresholds of the incident sources."""

    window_sec: int = 30
    burst: int = 8
    cpu: float = 80
    mem: float = 85
    lat: float = 200


def log_incident_stream(parsed: DataFrame, limits: Limits = Limits()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bursts, keyword incidents, fires) of parsed logs."""
    fires = burst_fires(parsed, limits.window_sec, limits.burst)
    bursts = detect_bursts(parsed, limits.window_sec, limits.burst, fires=fires)
    return bursts, log_incidents(parsed), fires


def incidents_of(logs: DataFrame, metrics: DataFrame, flag, limits: Limits = Limits()) -> DataFrame:
    """All incidents of raw logs and raw metrics. ``flag`` adds is_anomaly and anomaly_score to enriched metrics."""
    parsed = normalize_logs(logs)
    fires = burst_fires(parsed, limits.window_sec, limits.burst)
    whole = fires_whole(parsed, fires)
    bursts = detect_bursts(parsed, limits.window_sec, limits.burst, fires=fires, whole=whole)
    typed = type_anomalies(flag(enrich_metrics(metrics)), limits.cpu, limits.mem, limits.lat)
    return all_incidents(bursts, log_incidents(parsed), anomaly_incidents(typed), fires=fires, whole=whole)


def candidates_of(incidents: DataFrame, book: RuleBook) -> tuple[DataFrame, DataFrame]:
    """(allowed, rejected) action candidates of incident records, with incident and action ids."""
    known = with_incident_id(canonicalize_incidents(incidents, book.aliases))
    return apply_policy(with_action_id(match_rules(known, book.rules, book.default_severity, book.prefixes)), book.policy)


def intents_of(incidents: DataFrame, book: RuleBook, require_approval: bool = False) -> DataFrame:
    """Emitted intents. The allowed candidates are written once, since cooldown reads them more than once."""
    allowed, _ = candidates_of(incidents, book)
    shared_dir(incidents.sparkSession)
    return to_intents(apply_cooldown(allowed.checkpoint()), require_approval)


def results_of(intents: DataFrame, approvals: DataFrame, as_of: int | None = None, **limits: int) -> DataFrame:
    return resolve_approvals(intents, approvals, True, as_of=as_of, **limits)
