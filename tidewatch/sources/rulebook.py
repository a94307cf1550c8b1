"""Rules, aliases and policy from a small configuration, as tables the operators broadcast."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.scalars import glob_regex, strip

# Above this many rows a configuration table is joined without a broadcast hint.
CONFIG_ROWS = 100_000
# Different lengths of pattern beginnings that rules are filed under; a record asks for that many at most.
PREFIX_LENGTHS = 24

# The rule set that is used when none is given.
DEFAULT_CONFIG = {
    "defaults": {"source": "auto_remediator", "severity": "warn", "cooldown_sec": 180},
    "service_aliases": {
        "payment-service": "payments",
        "payments-service": "payments",
        "auth-service": "auth",
        "db-service": "db",
        "orders-service": "orders",
    },
    "policy": {
        "allowlist_services": ["payments", "auth", "db", "orders"],
        "denylist_services": ["unknown"],
        "allowlist_action_types": ["SCALE_UP", "ROLLING_RESTART"],
    },
    "rules": [
        {
            "rule_id": "cpu_spike_scale_up",
            "incident_type": "CPU_SPIKE",
            "min_severity": "warn",
            "pattern": "*",
            "action_type": "SCALE_UP",
            "target_service": "{service}",
            "parameters": {"replicas_delta": 1, "reason": "cpu spike"},
            "cooldown_sec": 120,
        },
        {
            "rule_id": "latency_spike_scale_up",
            "incident_type": "LATENCY_SPIKE",
            "min_severity": "warn",
            "pattern": "*",
            "action_type": "SCALE_UP",
            "target_service": "{service}",
            "parameters": {"replicas_delta": 1, "reason": "latency spike"},
            "cooldown_sec": 120,
        },
        {
            "rule_id": "error_rate_rolling_restart",
            "incident_type": "ERROR_RATE_SPIKE",
            "min_severity": "error",
            "pattern": "*",
            "action_type": "ROLLING_RESTART",
            "target_service": "{service}",
            "parameters": {"reason": "error rate spike"},
            "cooldown_sec": 180,
        },
        {
            "rule_id": "memory_spike_restart",
            "incident_type": "MEMORY_SPIKE",
            "min_severity": "warn",
            "pattern": "*",
            "action_type": "ROLLING_RESTART",
            "target_service": "{service}",
            "parameters": {"reason": "memory spike"},
            "cooldown_sec": 300,
        },
    ],
}


class Policy(NamedTuple):
    """Guards on remediation; an empty allow list lets everything through."""

    allow_services: tuple[str, ...] = ()
    deny_services: tuple[str, ...] = ()
    allow_actions: tuple[str, ...] = ()


class RuleBook(NamedTuple):
    """``rules`` are filed by incident type and ``prefix``, the literal beginning of the pattern; ``prefixes`` are the lengths that occur."""

    rules: DataFrame
    aliases: DataFrame
    policy: Policy
    default_severity: str
    prefixes: tuple[int, ...] = (0,)


def literal_prefix(pattern: str) -> str:
    """What every name that a shell-style pattern fits begins with."""
    return pattern[: min([i for i in map(pattern.find, "*?[") if i >= 0], default=len(pattern))]


def filed_prefixes(patterns: Sequence[str], most: int = PREFIX_LENGTHS) -> list[str]:
    """The literal beginnings, cut so that at most ``most`` different lengths (0 among them) are left."""
    found = [literal_prefix(p) for p in patterns]
    if len({0, *map(len, found)}) > most:
        step = -(-max(map(len, found)) // (most - 1))
        found = [x[: len(x) // step * step] for x in found]
    return found


def read_config(path: str) -> dict:
    """Configuration from a YAML or JSON file."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return json.load(f) or {}
        try:
            import yaml
        except ImportError as e:
            raise ImportError("reading YAML rules needs PyYAML; use a .json file instead") from e
        return yaml.safe_load(f) or {}


def _config_table(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= CONFIG_ROWS else df


def load_rules(spark: SparkSession, config: Mapping | str | None = None) -> RuleBook:
    """Rule, alias and policy tables from a mapping, a file path, or the default rule set.

    Entries that are no mapping, or lack rule_id, incident_type or action_type, are dropped; other
    missing fields get their defaults. Rule ids are expected to be unique.
    """
    cfg = read_config(config) if isinstance(config, str) else (DEFAULT_CONFIG if config is None else config)
    defaults = cfg.get("defaults") or {}
    policy = cfg.get("policy") or {}
    severity = str(defaults.get("severity", "warn"))

    text = ("rule_id", "incident_type", "min_severity", "pattern", "action_type", "target_service")
    raw = [r for r in cfg.get("rules") or [] if isinstance(r, Mapping)]
    patterns = [str("*" if r.get("pattern") is None else r["pattern"]).strip() for r in raw]
    prefixes = filed_prefixes(patterns)
    rows = [
        (
            i,
            *[None if r.get(c) is None else str(r[c]) for c in text],
            glob_regex(str(r.get("pattern", "*")).strip()),
            prefixes[i],
            json.dumps(r.get("parameters") or {}, sort_keys=True, separators=(",", ":"), ensure_ascii=False),
            None if r.get("cooldown_sec") is None else int(r["cooldown_sec"]),
        )
        for i, r in enumerate(raw)
    ]
    schema = "rule_order int, " + ", ".join(f"{c} string" for c in text)
    table = spark.createDataFrame(rows, schema + ", regex string, prefix string, parameters string, cooldown_sec int")
    filled = table.select(
        "rule_order",
        strip("rule_id").alias("rule_id"),
        strip("incident_type").alias("incident_type"),
        strip(F.coalesce("min_severity", F.lit(severity))).alias("min_severity"),
        strip(F.coalesce("pattern", F.lit("*"))).alias("pattern"),
        strip("action_type").alias("action_type"),
        strip(F.coalesce("target_service", F.lit("{service}"))).alias("target_service"),
        "regex",
        "prefix",
        "parameters",
        F.coalesce("cooldown_sec", F.lit(int(defaults.get("cooldown_sec", 180)))).alias("cooldown_sec"),
    )
    rules = filled.filter((F.col("rule_id") != "") & (F.col("incident_type") != "") & (F.col("action_type") != ""))

    given = cfg.get("service_aliases") or {}
    given = given if isinstance(given, Mapping) else {}
    alias_of = {str(k).strip().lower(): str(v).strip().lower() for k, v in given.items()}
    pairs = [(k, v) for k, v in alias_of.items() if k and v]
    aliases = spark.createDataFrame(pairs, "alias string, canonical string")

    def names(key: str, lower: bool) -> tuple[str, ...]:
        out = [str(x).strip() for x in policy.get(key) or []]
        return tuple(x.lower() if lower else x for x in out if x)

    guards = Policy(
        names("allowlist_services", True), names("denylist_services", True), names("allowlist_action_types", False)
    )
    lengths = tuple(sorted({0, *map(len, prefixes)}))
    return RuleBook(_config_table(rules, len(rows)), _config_table(aliases, len(pairs)), guards, severity, lengths)
