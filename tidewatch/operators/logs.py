"""Log records: normalization and keyword incidents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import canonical_json, lookup, or_default, regex_escape

# Severity of each log level; any other level is "info".
LEVEL_SEVERITY = {
    "DEBUG": "debug",
    "INFO": "info",
    "WARN": "warn",
    "WARNING": "warn",
    "ERROR": "error",
    "CRITICAL": "critical",
    "FATAL": "critical",
}

LOG_FIELDS = ("timestamp", "service", "message", "severity", "trace_id", "original_level")


class Keyword(NamedTuple):
    """A message holding any of ``needles`` is an incident; severities in ``raised`` become ``to``."""

    incident_type: str
    needles: tuple[str, ...]
    raised: tuple[str, ...]
    to: str


# Keyword rules, first match wins.
KEYWORDS = (
    Keyword("AUTH_FAILURE", ("authentication failed",), ("info", "warn"), "error"),
    Keyword("DB_LATENCY", ("db connection slow", "db latency"), ("info",), "warn"),
    Keyword("REQUEST_TIMEOUT", ("payment request timeout", "request timeout"), ("info", "warn"), "error"),
    Keyword("CACHE_STORM", ("cache miss", "cache storm"), ("info",), "warn"),
)


def normalize_logs(df: DataFrame) -> DataFrame:
    """Raw logs to parsed logs. Columns outside the raw layout (such as ts and seq) are kept."""
    level = F.upper(or_default("level", "INFO"))
    raw = ("timestamp", "service", "level", "message", "trace_id")
    return df.select(
        "timestamp",
        or_default("service", "unknown").alias("service"),
        F.coalesce("message", F.lit("")).alias("message"),
        lookup(level, LEVEL_SEVERITY, "info").alias("severity"),
        "trace_id",
        level.alias("original_level"),
        *[c for c in df.columns if c not in raw],
    )


def log_json() -> Column:
    """The parsed log as canonical JSON."""
    return canonical_json({c: F.col(c) for c in LOG_FIELDS})


def classify_keywords(df: DataFrame, keywords: Sequence[Keyword] = KEYWORDS) -> DataFrame:
    """Parsed logs that hit a keyword rule, with ``incident_type`` and ``incident_severity``.

    Rows are first kept by one pattern over all needles: a filter that names the message once stays small
    when it is pushed below the expressions the message is made of.
    """
    message = F.lower("message")
    severity = F.lower(or_default("severity", "info"))
    needles = [n for rule in keywords for n in rule.needles]
    found = df.filter(message.rlike("|".join(regex_escape(n) for n in needles)))
    kind, raised = F, F
    for rule in keywords:
        hit = reduce(or_, [message.contains(n) for n in rule.needles])
        level = F.when(severity.isin(*rule.raised), F.lit(rule.to)).otherwise(severity)
        kind = kind.when(hit, F.lit(rule.incident_type))
        raised = raised.when(hit, level)
    return found.withColumns({"incident_type": kind, "incident_severity": raised})


def log_incidents(df: DataFrame, keywords: Sequence[Keyword] = KEYWORDS) -> DataFrame:
    """Keyword incidents of parsed logs, as incident records; extra columns are kept."""
    service = or_default("service", "unknown")
    found = classify_keywords(df, keywords)
    return found.select(
        "timestamp",
        service.alias("service"),
        F.col("incident_severity").alias("severity"),
        "incident_type",
        F.lit("logs_parsed").alias("source"),
        canonical_json({"log": log_json(), "service": service}, raw=("log",)).alias("details"),
        *[c for c in df.columns if c not in LOG_FIELDS],
    )
