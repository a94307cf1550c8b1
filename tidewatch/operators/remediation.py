"""From incidents to action intents: canonical names, rules, policy, ids, cooldown and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalars import (
    canonical_json,
    glob_match_column,
    iso_z,
    micros,
    or_default,
    render_target,
    severity_rank,
    stable_id,
    strip,
)
from tidewatch.operators.blocks import number_rows
from tidewatch.operators.bursts import SECOND
from tidewatch.operators.folds import block_fold
from tidewatch.operators.joins import broadcast_if_small, picked_and_rest
from tidewatch.operators.spacing import greedy_spacing
from tidewatch.sources.rulebook import Policy

RULE_COLUMNS = ("rule_order", "rule_id", "action_type", "target_service", "parameters", "cooldown_sec")
DEDUP_TTL = 600


def canonicalize_incidents(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """Trim and lower service and severity and replace service aliases.

    ``_service_alias_raw`` and ``_service_alias_canonical`` are set where an alias changed the service.
    Blank or missing values are left as they are. ``target_service``, ``target`` and ``service_name``
    are replaced too where the columns exist.
    """

    def aliased(frame: DataFrame, column: str, out: str) -> DataFrame:
        table = aliases.select(F.col("alias").alias("_alias"), F.col("canonical").alias("_canonical"))
        name = F.lower(strip(column))
        joined = frame.join(table, name == F.col("_alias"), "left")
        return joined.withColumn(out, F.coalesce("_canonical", name)).drop("_alias", "_canonical")

    raw = F.lower(strip("service"))
    severity = F.lower(strip("severity"))
    severity = F.when(severity == "warning", "warn").otherwise(severity)
    out = aliased(df, "service", "_name")
    changed = (raw != "") & (raw != F.col("_name"))
    out = out.withColumns(
        {
            "_service_alias_raw": F.when(changed, raw),
            "_service_alias_canonical": F.when(changed, F.col("_name")),
            "severity": F.when(severity != "", severity).otherwise(F.col("severity")),
        }
    )
    out = out.withColumn("service", F.when(raw != "", F.col("_name")).otherwise(F.col("service"))).drop("_name")
    for column in ("target_service", "target", "service_name"):
        if column in df.columns:
            out = aliased(out, column, column)
    return out


def filed_rules(incidents: DataFrame, rules: DataFrame, prefixes: Sequence[int] = (0,)) -> DataFrame:
    """Every incident with the rules filed under its type and a beginning of its service: few of all rules of the type.

    ``prefixes`` are the lengths that rules are filed under (``RuleBook.prefixes``). A rule has one, so it meets an incident once.
    """
    service = F.coalesce("service", F.lit("unknown"))
    begins = F.array(*[F.when(F.length(service) >= n, F.substring(service, 1, n)) for n in prefixes])
    asked = incidents.withColumn("_begin", F.explode(F.filter(begins, lambda x: x.isNotNull())) if len(prefixes) > 1 else F.lit(""))
    return asked.join(rules, (strip(asked["incident_type"]) == rules["incident_type"]) & (asked["_begin"] == rules["prefix"]))


def match_rules(incidents: DataFrame, rules: DataFrame, default_severity: str = "warn", prefixes: Sequence[int] = (0,)) -> DataFrame:
    """Every (incident, rule) pair whose type, severity floor and service pattern fit, with rendered target.

    Incident type and the literal beginning of the pattern are equalities, so this is a hash join in which an incident meets only rules
    that may fit; the rest is a residual filter. A pattern that begins with a wildcard is filed under its type alone.
    """
    clash = {c: f"incident_{c}" for c in (*RULE_COLUMNS, "prefix", "regex", "pattern", "min_severity") if c in incidents.columns}
    left = incidents.withColumnsRenamed(clash)
    service = F.coalesce(left["service"], F.lit("unknown"))
    severity = F.coalesce(left["severity"], F.lit(default_severity))
    if prefixes == (0,):
        # Nothing to file by: also rules that are longer filed are found.
        met = left.join(rules, strip(left["incident_type"]) == rules["incident_type"])
    else:
        met = filed_rules(left, rules, prefixes)
    fits = (severity_rank(severity) >= severity_rank(rules["min_severity"])) & glob_match_column(service, rules["pattern"], rules["regex"])
    template = or_default(rules["target_service"], "{service}")
    back = {new: old for old, new in clash.items() if old not in RULE_COLUMNS}
    return met.filter(fits).select(
        *[left[c].alias(back.get(c, c)) for c in left.columns],
        rules["rule_order"],
        rules["rule_id"],
        rules["action_type"],
        render_target(template, service).alias("target_service"),
        rules["parameters"],
        rules["cooldown_sec"],
    )


def policy_reason(policy: Policy) -> Column:
    target = F.lower(strip(F.coalesce("target_service", F.lit(""))))
    reason = F.when(F.lit(False), F.lit(""))
    if policy.deny_services:
        reason = reason.when(target.isin(*policy.deny_services), "denylist_service")
    if policy.allow_services:
        reason = reason.when(~target.isin(*policy.allow_services), "not_in_allowlist")
    if policy.allow_actions:
        reason = reason.when(~strip("action_type").isin(*policy.allow_actions), "action_type_not_allowed")
    return reason.otherwise("allowed")


def apply_policy(candidates: DataFrame, policy: Policy) -> tuple[DataFrame, DataFrame]:
    """(allowed, rejected) candidates; the rejected ones carry the first failing check as ``reason``."""
    judged = candidates.withColumn("reason", policy_reason(policy))
    allowed = F.col("reason") == "allowed"
    return judged.filter(allowed).drop("reason"), judged.filter(~allowed)


def with_incident_id(df: DataFrame) -> DataFrame:
    """``incident_id``, hashed from the record where not given, and ``correlation_id``, defaulting to it.

    Apply after canonicalization; ``details`` holds canonical JSON.
    """
    names = ("timestamp", "service", "incident_type", "source")
    hashed = stable_id(
        canonical_json(
            {**{c: F.col(c) for c in names}, "details": F.coalesce("details", F.lit("{}"))}, raw=("details",)
        )
    )
    for column in ("incident_id", "correlation_id"):
        if column not in df.columns:
            df = df.withColumn(column, F.lit(None).cast("string"))
    out = df.withColumn("incident_id", F.coalesce(F.nullif("incident_id", F.lit("")), hashed))
    return out.withColumn("correlation_id", F.coalesce(F.nullif("correlation_id", F.lit("")), F.col("incident_id")))


def with_action_id(df: DataFrame) -> DataFrame:
    names = ("incident_id", "rule_id", "action_type", "target_service")
    fields = {**{c: F.col(c) for c in names}, "parameters": F.col("parameters")}
    return df.withColumn("action_id", stable_id(canonical_json(fields, raw=("parameters",))))


# Fields of an incident that an intent embeds, where present.
EMBEDDED = (
    "timestamp", "service", "severity", "incident_type", "source", "details", "incident_id", "correlation_id",
    "test_id", "trace_id", "_service_alias_raw", "_service_alias_canonical",
)


def to_intents(df: DataFrame, require_approval: bool = False, ts: str = "ts") -> DataFrame:
    """ACTION_INTENT records of allowed candidates that have their ids; the event time is kept."""
    optional = [c if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("test_id", "trace_id")]
    own = {*EMBEDDED, *RULE_COLUMNS, "event_type", "action_id", "status", "incident", "action_at"}
    embedded = F.to_json(F.struct(*[c for c in sorted(EMBEDDED) if c in df.columns]))
    return df.select(
        F.lit("ACTION_INTENT").alias("event_type"),
        F.coalesce(F.nullif("timestamp", F.lit("")), iso_z(ts)).alias("timestamp"),
        F.coalesce("service", F.lit("unknown")).alias("service"),
        F.lit("warn").alias("severity"),
        "action_id",
        "correlation_id",
        *optional,
        "incident_id",
        "rule_id",
        F.lit("PROPOSED" if require_approval else "APPROVED").alias("status"),
        "action_type",
        "target_service",
        "parameters",
        F.lit("auto_remediator").alias("source"),
        embedded.alias("incident"),
        *[c for c in df.columns if c not in own],
    )


def dedup_ttl(
    df: DataFrame, key: str = "action_id", ttl: int = DEDUP_TTL, ts: str = "ts", seq: Sequence[str] = ("seq",)
) -> DataFrame:
    """Drop a row whose key was kept at most ``ttl`` seconds before, the exact end included; and rows without key or time."""
    placed = df.withColumn("_at", micros(ts)).dropna(subset=[key, "_at"])
    return greedy_spacing(placed, [key], "_at", list(seq), ttl * SECOND + 1).drop("_at")


def remediation_step(state: dict, row: dict, ttl: int) -> list[dict]:
    """Sequential rule of one (rule, target): silent during the cooldown, then one emission per action id and TTL."""
    now = row["_at"]
    seen = {k: until for k, until in state.get("seen", {}).items() if until >= now}
    state["seen"] = seen
    if now < state.get("free", now) or row["action_id"] in seen:
        return []
    seen[row["action_id"]] = now + ttl * SECOND
    state["free"] = now + max(0, row["cooldown_sec"]) * SECOND
    return [row]


def _repeated_within(spaced: DataFrame, key: Sequence[str], order: Sequence[str], ttl: int) -> DataFrame | None:
    """The keys for which some action id comes twice within ``ttl`` seconds; None if no id comes twice at all.

    Only rows of ids that come twice are ordered, in blocks, so one id may have any number of them.
    """
    ids = [*key, "action_id"]
    twice = spaced.groupBy(*ids).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*ids)
    if twice.isEmpty():
        return None
    again = spaced.join(broadcast_if_small(twice.checkpoint()), ids, "left_semi").select(*ids, *order)
    since = number_rows(again, ids, order, lag_of="_at", lag_name="_before")
    return since.filter(F.col("_at") - F.col("_before") <= ttl * SECOND).select(*key).distinct()


def apply_cooldown(candidates: DataFrame, ttl: int = DEDUP_TTL, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Candidates that become intents: outside the cooldown of (rule, target), and no repeated action id.

    Only an emission starts a cooldown or a TTL. Without the TTL this is greedy spacing, which runs in
    parallel at any key size. The TTL can only matter for a (rule, target) on which spacing emitted some
    action id twice within it; just those, normally none, go through the ordered fold. An incident delivered again
    is one more candidate and is silenced like any other. Candidates without a time or number are left out.
    """
    key = ["rule_id", "target_service"]
    order = ["_at", seq, "rule_order"]
    placed = candidates.withColumn("_at", micros(ts))
    narrow = placed.select(*key, *order, "cooldown_sec", "action_id").dropna(subset=[*key, *order])
    spaced = greedy_spacing(narrow, key, "_at", order[1:], F.col("cooldown_sec").cast("bigint") * SECOND).checkpoint()

    # Without the TTL more would be emitted than with it, so an id that comes back only after its TTL needs no fold.
    repeated = _repeated_within(spaced, key, order, ttl)
    if repeated is not None:
        known = broadcast_if_small(repeated.checkpoint())
        schema = T.StructType([f for f in narrow.schema.fields])
        folded = block_fold(
            narrow.join(known, key, "left_semi"),
            key,
            order,
            lambda state, row: remediation_step(state, row, ttl),
            lambda state: [],
            schema,
        )
        spaced = spaced.join(known, key, "left_anti").unionByName(folded)
    taken, _ = picked_and_rest(placed, spaced.select(*key, *order), [*key, *order])
    return taken.select(*candidates.columns)
