"""For each registered query the same result in plain SQL over the test tables."""

from __future__ import annotations

# Values of the queries' limits, rules, aliases and messages, written out here so that a wrong one elsewhere shows.
WINDOW_SEC, BURST, CPU, MEM, LAT = 30, 4, 55, 65, 100
ISO = "'%Y-%m-%dT%H:%M:%SZ'"

EVENTS = f"""
ev AS (
  SELECT event_id AS seq, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id) AS tm,
         1704067200 + event_id AS sec,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id), {ISO}) AS timestamp,
         (['payments','orders','auth','db'])[CAST(user_id % 4 AS INT) + 1] AS service,
         user_id, event_type, value, ts AS happened_at,
         CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events)"""

LOGS = (
    EVENTS
    + """,
logs AS (
  SELECT seq, tm, sec, timestamp, service, 'trace-' || seq AS trace_id,
         CASE k % 10 WHEN 0 THEN 'sign-in refused, authentication failed: account ' || user_id
                     WHEN 1 THEN 'pool warning: db connection slow again'
                     WHEN 2 THEN 'no answer in time, request timeout at the till'
                     WHEN 3 THEN 'too many a cache miss since midnight'
                     ELSE 'nothing to report, entry ' || seq END AS message,
         CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warn' WHEN 'purchase' THEN 'debug'
                         ELSE 'info' END AS severity,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' WHEN 'purchase' THEN 'DEBUG'
                         ELSE 'INFO' END AS original_level
  FROM ev),
logj AS (
  SELECT *, '{"message":"' || message || '","original_level":"' || original_level || '","service":"' || service
         || '","severity":"' || severity || '","timestamp":"' || timestamp || '","trace_id":"' || trace_id || '"}' AS js
  FROM logs)"""
)

KEYWORDS = (
    LOGS
    + """,
kw AS (
  SELECT seq, tm, sec, timestamp, service,
         CASE WHEN kind IN ('AUTH_FAILURE', 'REQUEST_TIMEOUT') AND severity IN ('info', 'warn') THEN 'error'
              WHEN kind IN ('DB_LATENCY', 'CACHE_STORM') AND severity = 'info' THEN 'warn'
              ELSE severity END AS severity,
         kind AS incident_type, 'logs_parsed' AS source,
         '{"log":' || js || ',"service":"' || service || '"}' AS details
  FROM (SELECT *, CASE WHEN message LIKE '%authentication failed%' THEN 'AUTH_FAILURE'
                       WHEN message LIKE '%db connection slow%' THEN 'DB_LATENCY'
                       WHEN message LIKE '%request timeout%' THEN 'REQUEST_TIMEOUT'
                       WHEN message LIKE '%cache miss%' THEN 'CACHE_STORM' END AS kind FROM logj)
  WHERE kind IS NOT NULL)"""
)

_METRIC = """,
raw AS (SELECT *, value % 100 AS cpu, CAST(k AS DOUBLE) AS mem, value AS lat FROM ev),
flags AS (
  SELECT seq, tm, sec, timestamp, service, cpu, mem, lat, cpu > 80 AS is_high_cpu, mem > 85 AS is_high_memory,
         lat > 200 AS is_high_latency,
         CASE WHEN lat > 200 THEN 'error' WHEN cpu > 80 OR mem > 85 THEN 'warn' ELSE 'info' END AS severity,
         CASE WHEN mem > 0 THEN {RATIO} ELSE 0.0 END AS cpu_to_memory_ratio
  FROM (SELECT *, CASE WHEN mem > 0 THEN cpu / mem ELSE 0.0::DOUBLE END AS x FROM raw)),
met AS (
  SELECT *, avg(cpu) OVER w AS cpu_avg_5, avg(mem) OVER w AS memory_avg_5, avg(lat) OVER w AS latency_avg_5
  FROM flags WINDOW w AS ({over} ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"""
# Rounding by the exact binary value: the product with 10^4 plus its rounding error.
_HIGH = "(x * 134217729.0::DOUBLE - (x * 134217729.0::DOUBLE - x))"
_PRODUCT = "(x * 10000.0::DOUBLE)"
_OVER = f"(({_PRODUCT} - floor({_PRODUCT}) - 0.5::DOUBLE) + (({_HIGH} * 10000.0::DOUBLE - {_PRODUCT}) + (x - {_HIGH}) * 10000.0::DOUBLE))"
_RATIO = (
    f"(floor({_PRODUCT}) + CASE WHEN {_OVER} > 0 OR ({_OVER} = 0 AND floor({_PRODUCT}) % 2 <> 0) "
    "THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) / 10000.0::DOUBLE"
)
_METRIC = _METRIC.replace("{RATIO}", _RATIO)
METRICS = _METRIC.replace("{over}", "")
METRICS_BY_SERVICE = _METRIC.replace("{over}", "PARTITION BY service")

ML = (
    METRICS
    + f""",
scored AS (
  SELECT *, greatest(cpu_avg_5 - 50, memory_avg_5 - 60, latency_avg_5 - 90) AS far FROM met),
ml AS (
  SELECT seq, tm, sec, timestamp, service, cpu_avg_5, memory_avg_5, latency_avg_5, -far / 100 AS anomaly_score,
         far > 0 AS is_anomaly,
         CASE WHEN NOT far > 0 THEN 'NONE' WHEN cpu_avg_5 > {CPU} THEN 'CPU_SPIKE'
              WHEN latency_avg_5 > {LAT} THEN 'LATENCY_SPIKE'
              WHEN memory_avg_5 > {MEM} THEN 'MEMORY_SPIKE' ELSE 'UNKNOWN_ANOMALY' END AS anomaly_type,
         CASE WHEN NOT far > 0 THEN 'info' WHEN cpu_avg_5 > {CPU} THEN 'warn'
              WHEN latency_avg_5 > {LAT} THEN 'error' ELSE 'warn' END AS severity
  FROM scored),
an AS (
  SELECT seq, tm, sec, timestamp, service, severity, anomaly_type AS incident_type, 'ml_output' AS source
  FROM ml WHERE is_anomaly)"""
)

BURSTS = f""",
num AS MATERIALIZED (
  SELECT *, row_number() OVER w AS rn, lag(sec, {BURST - 1}) OVER w AS old
  FROM logj WHERE severity IN ('error', 'critical') WINDOW w AS (PARTITION BY service ORDER BY sec, seq)),
cand AS MATERIALIZED (SELECT service, rn FROM num WHERE sec - old <= {WINDOW_SEC}),
nx AS MATERIALIZED (
  SELECT a.service, a.rn, min(b.rn) AS nrn FROM cand a JOIN cand b ON a.service = b.service AND b.rn >= a.rn + {BURST}
  GROUP BY a.service, a.rn),
fire AS (
  SELECT service, min(rn) AS rn FROM cand GROUP BY service
  UNION ALL
  SELECT nx.service, nx.nrn FROM fire JOIN nx ON nx.service = fire.service AND nx.rn = fire.rn),
bu AS (
  SELECT n.seq, n.tm, n.sec, n.timestamp, n.service, 'critical' AS severity, 'ERROR_RATE_SPIKE' AS incident_type,
         'logs_parsed' AS source,
         '{{"count":{BURST},"sample_log":' || js || ',"threshold":{BURST},"window_sec":{WINDOW_SEC}}}' AS details
  FROM num n JOIN fire f ON n.service = f.service AND n.rn = f.rn)"""


def _spelled(table: str) -> str:
    return f"""
  SELECT * REPLACE (
    CASE seq % 6 WHEN 0 THEN upper(service) WHEN 1 THEN service || '-service' WHEN 2 THEN '  ' || service || ' '
                 WHEN 3 THEN 'unknown' WHEN 4 THEN '' ELSE service END AS service,
    CASE WHEN seq % 3 = 0 THEN upper(severity) WHEN seq % 3 = 1 AND severity = 'warn' THEN ' Warning'
         ELSE severity END AS severity)
  FROM {table}"""


def _values(rows: list[tuple]) -> str:
    def lit(v: object) -> str:
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


ALIASES = """,
alias(a, c) AS (VALUES ('payment-service', 'payments'), ('payments-service', 'payments'), ('auth-service', 'auth'),
                       ('db-service', 'db'), ('orders-service', 'orders'))"""

CANON = """,
canon AS (
  SELECT s.* REPLACE (
           CASE WHEN lower(trim(service)) <> '' THEN coalesce(c, lower(trim(service))) ELSE service END AS service,
           CASE WHEN lower(trim(severity)) = 'warning' THEN 'warn' ELSE lower(trim(severity)) END AS severity),
         CASE WHEN c <> lower(trim(service)) THEN lower(trim(service)) END AS alias_raw,
         CASE WHEN c <> lower(trim(service)) THEN c END AS alias_canonical
  FROM spelled s LEFT JOIN alias ON a = lower(trim(s.service)))"""


_RULES = [
    ("cpu_spike_scale_up", "CPU_SPIKE", 1, "SCALE_UP", '{"reason":"cpu spike","replicas_delta":1}', 120),
    ("latency_spike_scale_up", "LATENCY_SPIKE", 1, "SCALE_UP", '{"reason":"latency spike","replicas_delta":1}', 120),
    ("error_rate_rolling_restart", "ERROR_RATE_SPIKE", 2, "ROLLING_RESTART", '{"reason":"error rate spike"}', 180),
    ("memory_spike_restart", "MEMORY_SPIKE", 1, "ROLLING_RESTART", '{"reason":"memory spike"}', 300),
]

SPIKES = """,
spike AS (
  SELECT seq, sec, timestamp, service, severity, incident_type, source, details, CAST(NULL AS VARCHAR) AS given FROM bu
  UNION ALL
  SELECT seq, sec, timestamp, service, severity, incident_type, source, NULL, 'anomaly-' || seq FROM an)"""

MATCH = f""",
rule(rule_id, kind, floor, action_type, parameters, cooldown_sec) AS (VALUES {_values(_RULES)}),
cands AS (
  SELECT c.*, rule_id, action_type, parameters, cooldown_sec, service AS target_service
  FROM canon c JOIN rule ON kind = incident_type
   AND CASE severity WHEN 'warn' THEN 1 WHEN 'error' THEN 2 WHEN 'critical' THEN 3 ELSE 0 END >= floor),
judged AS (
  SELECT *, CASE WHEN target_service = 'unknown' THEN 'denylist_service'
                 WHEN target_service NOT IN ('payments', 'auth', 'db', 'orders') THEN 'not_in_allowlist'
                 WHEN action_type NOT IN ('SCALE_UP', 'ROLLING_RESTART') THEN 'action_type_not_allowed'
                 ELSE 'allowed' END AS reason
  FROM cands),
ided AS (
  SELECT *, coalesce(given, substr(sha256('{{"details":' || details || ',"incident_type":"' || incident_type
              || '","service":"' || service || '","source":"' || source || '","timestamp":"' || timestamp || '"}}'), 1, 24)) AS incident_id
  FROM judged WHERE reason = 'allowed'),
acts AS MATERIALIZED (
  SELECT *, substr(sha256('{{"action_type":"' || action_type || '","incident_id":"' || incident_id || '","parameters":'
              || parameters || ',"rule_id":"' || rule_id || '","target_service":"' || target_service || '"}}'), 1, 24) AS action_id
  FROM ided)"""

COOLDOWN = """,
cnx AS MATERIALIZED (
  SELECT a.rule_id, a.target_service, a.sec, min(b.sec) AS nsec
  FROM acts a JOIN acts b ON a.rule_id = b.rule_id AND a.target_service = b.target_service
   AND b.sec >= a.sec + a.cooldown_sec
  GROUP BY ALL),
kept AS (
  SELECT rule_id, target_service, min(sec) AS sec FROM acts GROUP BY ALL
  UNION ALL
  SELECT cnx.rule_id, cnx.target_service, cnx.nsec FROM kept JOIN cnx
    ON cnx.rule_id = kept.rule_id AND cnx.target_service = kept.target_service AND cnx.sec = kept.sec),
emitted AS (SELECT acts.* FROM acts JOIN kept USING (rule_id, target_service, sec))"""

_MESSAGE = " ".join(
    f"WHEN '{name}' THEN " + "'" + text.replace("{}", "' || target_service || '") + "'"
    for name, text in (("SCALE_UP", "Scaled up {}"), ("ROLLING_RESTART", "Performed rolling restart on {}"))
)
APPROVALS = f""",
answered AS (
  SELECT *, CASE WHEN action_id[1] BETWEEN '0' AND '4' THEN 'EXECUTED' WHEN action_id[1] BETWEEN '5' AND '9' THEN 'DENIED' END AS said,
         CASE WHEN action_id[2] BETWEEN '0' AND '9' THEN 60 ELSE 1000 END AS late
  FROM emitted),
results AS (
  SELECT *, 'PENDING_APPROVAL' AS status, sec AS rsec FROM answered
  UNION ALL
  SELECT *, CASE WHEN said IS NOT NULL AND late < 900 THEN said ELSE 'EXPIRED' END,
         sec + CASE WHEN said IS NOT NULL AND late < 900 THEN late ELSE 900 END FROM answered),
res AS (
  SELECT 'ACTION_RESULT' AS event_type, action_id, action_type, target_service, status,
         CASE status WHEN 'EXECUTED' THEN CASE action_type {_MESSAGE} END
                     WHEN 'PENDING_APPROVAL' THEN 'Awaiting human approval' WHEN 'DENIED' THEN 'Denied by approver'
                     ELSE 'Approval timeout (900s) exceeded' END AS message,
         CAST(rsec AS BIGINT) * 1000 AS ts, incident_id, rule_id,
         CASE WHEN status = 'EXECUTED' THEN action_type END AS executed_action,
         CASE WHEN status = 'DENIED' THEN 'operator' END AS approver, sec, rsec
  FROM results)"""

RECURSIVE_BASE = LOGS + ML + BURSTS + SPIKES
SPELLED_SPIKES = RECURSIVE_BASE + ",\nspelled AS (" + _spelled("spike") + ")" + ALIASES + CANON + MATCH
PLAIN_SPIKES = RECURSIVE_BASE + ",\nspelled AS (SELECT * FROM spike)" + ALIASES + CANON + MATCH + COOLDOWN + APPROVALS

STORE = (
    KEYWORDS
    + METRICS[: METRICS.index(",\nmet AS")]
    + """,
store AS (
  SELECT 'ops' AS source, 'logs_parsed' AS topic, service, severity, message, timestamp, tm, seq, NULL AS kind FROM logs
  UNION ALL
  SELECT 'ops', 'metrics_enriched', service, severity, NULL, timestamp, tm, seq, NULL FROM flags
  UNION ALL
  SELECT 'ops', 'incidents', service, severity, NULL, timestamp, tm, seq, incident_type FROM kw)"""
)


def _q(ctes: str, select: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ctes + "\n" + select


def _grid(range_sec: int, step: int, where: str, by: str = "") -> str:
    """Brute force: every evaluation time on the grid with the lines in (t - range, t]."""
    cols = f", {by}" if by else ""
    return f"""
  SELECT t, strftime(make_timestamp(t * 1000000), {ISO}) AS eval_at{cols}, count(*) AS n
  FROM (SELECT *, epoch_ms(tm) // 1000 AS s FROM store WHERE {where}),
       LATERAL (SELECT unnest(range(CAST(ceil(s / {step}.0) AS BIGINT) * {step}, s + {range_sec}, {step})) AS t)
  GROUP BY ALL"""


def _bucket(minutes: int) -> str:
    return f"strftime(time_bucket(INTERVAL '{minutes} minutes', tm), {ISO}) AS bucket"


_FEATURES = "round(cpu_avg_5, 9) AS cpu_avg_5, round(memory_avg_5, 9) AS memory_avg_5, round(latency_avg_5, 9) AS latency_avg_5"
_ENRICHED = f"""SELECT seq, timestamp, service, severity, cpu AS cpu_percent, mem AS memory_percent, lat AS network_latency_ms,
  is_high_cpu, is_high_memory, is_high_latency, cpu_to_memory_ratio, {_FEATURES} FROM met"""
_EXTREMES = ", ".join(
    f"{f}({c}) OVER w AS {m}_{f}_5" for m, c in (("cpu", "cpu"), ("memory", "mem"), ("latency", "lat")) for f in ("max", "min")
)
_SIZES = ", ".join(f"count(*) OVER w AS {m}_size_5" for m in ("cpu", "memory", "latency"))

ORACLES: dict[str, str] = {
    "normalize_logs": _q(LOGS, "SELECT timestamp, service, message, severity, trace_id, original_level, seq FROM logs"),
    "keyword_incidents": _q(
        KEYWORDS, "SELECT timestamp, service, severity, incident_type, source, details, seq FROM kw"
    ),
    "incident_timeline": _q(
        KEYWORDS, f"SELECT {_bucket(1)}, service, incident_type, count(*) AS count FROM kw GROUP BY ALL"
    ),
    "enrich_metrics_global": _q(EVENTS + METRICS, _ENRICHED),
    "enrich_metrics_by_service": _q(EVENTS + METRICS_BY_SERVICE, _ENRICHED),
    "rolling_extremes": _q(
        EVENTS + METRICS,
        f"SELECT seq, service, {_EXTREMES}, {_SIZES} FROM flags "
        "WINDOW w AS (PARTITION BY service ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)",
    ),
    "anomaly_features": _q(
        EVENTS + METRICS,
        "SELECT seq, round(cpu_avg_5, 9) AS feature_0, round(memory_avg_5, 9) AS feature_1, round(latency_avg_5, 9) AS feature_2 FROM met",
    ),
    "anomaly_types": _q(
        EVENTS + ML,
        "SELECT seq, timestamp, service, severity, anomaly_type, is_anomaly, round(anomaly_score, 9) AS anomaly_score FROM ml",
    ),
    "anomaly_incidents": _q(
        EVENTS + ML,
        "SELECT seq, timestamp, service, severity, incident_type, source, incident_type AS detail_type FROM an",
    ),
    "error_window_counts": _q(
        LOGS,
        """SELECT seq, service, count(*) OVER (PARTITION BY service ORDER BY sec RANGE BETWEEN 30 PRECEDING AND CURRENT ROW)
           AS trailing_count FROM logs WHERE severity IN ('error', 'critical')""",
    ),
    "error_window_counts_redelivered": _q(
        LOGS
        + """,
timed AS (SELECT seq, service, CASE WHEN seq % 11 = 0 THEN NULL ELSE sec END AS sec FROM logs WHERE severity IN ('error', 'critical')),
copies AS (SELECT *, 0 AS c FROM timed UNION ALL SELECT *, 1 FROM timed WHERE seq % 7 = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY sec, seq, c) AS rn FROM copies WHERE sec IS NOT NULL)""",
        """SELECT seq, service, rn - min(rn) OVER (PARTITION BY service ORDER BY sec RANGE BETWEEN 30 PRECEDING AND CURRENT ROW) + 1
                  AS trailing_count FROM placed
           UNION ALL SELECT seq, service, NULL FROM copies WHERE sec IS NULL""",
    ),
    "forest_fixed_scores": _q(
        EVENTS
        + METRICS
        + """,
mean AS (
  SELECT n, CASE WHEN n = 1 THEN 0.0 WHEN n = 2 THEN 1.0 ELSE 2 * (ln(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n END AS path
  FROM (SELECT unnest([1.0, 2.0, 55.0, 200.0, 254.0, 256.0])::DOUBLE AS n)),
leaf AS (
  SELECT seq, CASE WHEN cpu_avg_5 <= 50 THEN 200 WHEN latency_avg_5 <= 90 THEN 55 ELSE 1 END AS n0,
         CASE WHEN cpu_avg_5 <= 50 THEN 1 ELSE 2 END AS d0, CASE WHEN memory_avg_5 <= 40 THEN 2 ELSE 254 END AS n1
  FROM met),
scored AS (
  SELECT seq, 0.5 - pow(2, -(d0 + a.path + 1 + b.path) / 2 / whole.path) AS s
  FROM leaf JOIN mean a ON a.n = n0 JOIN mean b ON b.n = n1 JOIN mean whole ON whole.n = 256)""",
        "SELECT seq, round(s, 9) AS anomaly_score, s < 0 AS is_anomaly FROM scored",
    ),
    "forest_fit_summary": """
        SELECT 100 AS trees, least(256, count(*))::INT AS smallest_root, least(256, count(*))::INT AS largest_root,
               TRUE AS depth_bounded, TRUE AS share_flagged FROM events""",
    "json_fields": _q(
        LOGS, "SELECT seq, severity, message, trace_id, original_level FROM logs",
    ),
    "error_bursts": _q(
        LOGS + BURSTS, "SELECT timestamp, service, severity, incident_type, source, details, seq FROM bu", True
    ),
    "all_incidents": _q(
        KEYWORDS + ML + BURSTS,
        """SELECT seq, timestamp, service, severity, incident_type, source FROM bu
           UNION ALL SELECT seq, timestamp, service, severity, incident_type, source FROM kw WHERE seq NOT IN (SELECT seq FROM bu)
           UNION ALL SELECT seq, timestamp, service, severity, incident_type, source FROM an""",
        True,
    ),
    "canonical_incidents": _q(
        KEYWORDS + ",\nspelled AS (" + _spelled("kw") + ")" + ALIASES + CANON,
        """SELECT seq, service, severity,
                  CASE WHEN seq % 6 = 4 THEN '' ELSE service END AS target, incident_type, alias_raw, alias_canonical FROM canon""",
    ),
    "rule_candidates": _q(
        SPELLED_SPIKES,
        "SELECT seq, incident_type, service, severity, rule_id, action_type, target_service, cooldown_sec FROM cands",
        True,
    ),
    "policy_decisions": _q(
        SPELLED_SPIKES, "SELECT seq, rule_id, action_type, target_service, reason FROM judged", True
    ),
    "glob_decisions": _q(
        KEYWORDS,
        """SELECT seq, rule_id, action_type, service AS target_service,
                  CASE WHEN service NOT IN ('payments', 'db') THEN 'not_in_allowlist'
                       WHEN action_type = 'REBOOT' THEN 'action_type_not_allowed' ELSE 'allowed' END AS reason
           FROM kw JOIN (VALUES ('any_letter', 'AUTH_FAILURE', ['db'], 'SCALE_UP'), ('set', 'DB_LATENCY', ['orders', 'payments'], 'REBOOT'),
                                ('other_set', 'REQUEST_TIMEOUT', ['orders', 'payments'], 'ROLLING_RESTART')) AS rule(rule_id, kind, services, action_type)
             ON kind = incident_type AND list_contains(services, service)
           WHERE severity IN ('warn', 'error', 'critical')""",
    ),
    "action_intents": _q(
        SPELLED_SPIKES,
        """SELECT seq, 'ACTION_INTENT' AS event_type, timestamp, service, 'warn' AS severity, incident_id,
                  incident_id AS correlation_id, action_id, rule_id, 'APPROVED' AS status, action_type, target_service,
                  parameters, 'auto_remediator' AS source FROM acts""",
        True,
    ),
    "intents_after_cooldown": _q(
        SPELLED_SPIKES + COOLDOWN,
        "SELECT seq, rule_id, target_service, action_id, 'APPROVED' AS status FROM emitted",
        True,
    ),
    "ttl_dedup": _q(
        EVENTS
        + """,
n AS MATERIALIZED (SELECT a.user_id, a.seq, min(b.seq) AS nseq FROM ev a JOIN ev b ON a.user_id = b.user_id AND b.seq > a.seq + 600 GROUP BY ALL),
keep AS (
  SELECT user_id, min(seq) AS seq FROM ev GROUP BY user_id
  UNION ALL
  SELECT n.user_id, n.nseq FROM keep JOIN n ON n.user_id = keep.user_id AND n.seq = keep.seq)""",
        "SELECT 'action-' || user_id AS action_id, seq FROM keep",
        True,
    ),
    "approval_results": _q(PLAIN_SPIKES, "SELECT * EXCLUDE (sec, rsec) FROM res", True),
    "remediation_lifecycle": _q(
        PLAIN_SPIKES,
        """SELECT coalesce(i.given, substr(sha256('{"details":' || i.details || ',"incident_type":"' || i.incident_type
                  || '","service":"' || i.service || '","source":"' || i.source || '","timestamp":"' || i.timestamp || '"}'), 1, 24)) AS incident_id,
                  i.service, i.incident_type, e.rule_id, r.status AS terminal_status,
                  CASE WHEN e.action_id IS NOT NULL THEN 0.0::DOUBLE END AS sec_to_intent,
                  CAST(r.rsec - r.sec AS DOUBLE) AS sec_to_terminal
           FROM spike i LEFT JOIN emitted e ON e.seq = i.seq AND e.incident_type = i.incident_type
           LEFT JOIN res r ON r.action_id = e.action_id AND r.status <> 'PENDING_APPROVAL'""",
        True,
    ),
    "action_status": _q(
        PLAIN_SPIKES,
        """SELECT status, count(*) AS results, count(*) FILTER (status <> 'PENDING_APPROVAL') AS actions FROM res GROUP BY status""",
        True,
    ),
    "routed_actions": _q(
        PLAIN_SPIKES,
        """SELECT 'ACTION_INTENT' AS event_type, 'PROPOSED' AS status, NULL AS decision, count(*) AS records FROM emitted
           HAVING count(*) > 0
           UNION ALL
           SELECT 'ACTION_APPROVAL', NULL, CASE WHEN d BETWEEN '0' AND '2' THEN 'approve' WHEN d BETWEEN '3' AND '4' THEN ' YES '
                  WHEN d BETWEEN '5' AND '7' THEN 'Denied' WHEN d BETWEEN '8' AND '9' THEN 'n' ELSE 'maybe' END AS decision, count(*)
           FROM (SELECT action_id[1] AS d FROM emitted) WHERE d < 'c' GROUP BY ALL""",
        True,
    ),
    "fallback_match": _q(
        EVENTS,
        """SELECT seq, CASE WHEN k % 5 < 4 THEN 'incident-' || user_id END AS matched,
                  CASE WHEN k % 5 < 4 THEN k % 5 + 1 END AS matched_by FROM ev""",
    ),
    "missing_topics": _q(
        STORE,
        """SELECT topic FROM (VALUES ('logs_parsed'), ('metrics_enriched'), ('ml_output'), ('incidents'), ('actions'),
           ('logs_raw'), ('metrics_raw')) t(topic) WHERE topic NOT IN (SELECT topic FROM store)""",
    ),
    "log_lines": _q(
        PLAIN_SPIKES
        + """,
line AS (
  SELECT 'logs_parsed' AS topic, service, severity, message AS text, NULL AS message_service FROM logs
  UNION ALL SELECT 'metrics_enriched', service, severity, NULL, service FROM met
  UNION ALL SELECT 'ml_output', service, severity, NULL, service FROM ml
  UNION ALL SELECT 'incidents', service, severity, NULL, service FROM an
  UNION ALL SELECT 'actions', service, 'warn', NULL, service FROM emitted
  UNION ALL SELECT 'actions', 'unknown', 'info',
      CASE WHEN FALSE THEN message END, NULL FROM res)""",
        "SELECT 'ops' AS source, topic, service, severity, text, message_service, count(*) AS lines FROM line GROUP BY ALL",
        True,
    ),
    "log_store_round_trip": _q(
        STORE,
        """SELECT source, topic, service, severity, timestamp, seq, CAST(CAST(tm AS DATE) AS VARCHAR) AS dt
           FROM store WHERE topic = 'incidents' AND severity = 'error'""",
    ),
    "select_logs": _q(
        STORE,
        "SELECT topic, service, severity, timestamp, seq FROM store WHERE service = 'payments' AND severity = 'error'",
    ),
    "json_filter": _q(
        STORE, "SELECT topic, service, severity, kind, seq FROM store WHERE kind = 'AUTH_FAILURE'"
    ),
    "tail_errors": _q(
        STORE,
        """SELECT topic, service, severity, message, timestamp, seq FROM store
           WHERE topic = 'logs_parsed' AND severity = 'error' ORDER BY tm DESC, seq DESC LIMIT 100""",
    ),
    "range_query": _q(
        STORE,
        """SELECT service, severity, message, timestamp, seq FROM store WHERE topic = 'logs_parsed'
           AND tm BETWEEN TIMESTAMP '2024-01-01 00:05:00' AND TIMESTAMP '2024-01-01 00:15:00' ORDER BY tm DESC, seq DESC LIMIT 20""",
    ),
    "freshness": _q(
        STORE,
        f"""SELECT topic, strftime(max(tm), {ISO}) AS newest, max(tm) >= TIMESTAMP '2024-01-01 02:40:00' AS fresh
            FROM store GROUP BY topic""",
    ),
    "incident_count_1m": _q(STORE, f"SELECT eval_at, n AS count FROM ({_grid(60, 30, "topic = 'incidents'")})"),
    "incident_count_last": _q(
        STORE,
        f"SELECT service, max_by(n, t) AS count FROM ({_grid(60, 30, "topic = 'incidents'", 'service')}) GROUP BY service",
    ),
    "error_count_1m": _q(STORE, f"SELECT eval_at, n AS count FROM ({_grid(60, 60, "severity = 'error'")})"),
    "error_rate_by_service": _q(
        STORE,
        f"SELECT eval_at, service, round(n / 300.0::DOUBLE, 9) AS rate FROM ({_grid(300, 60, "severity = 'error'", 'service')})",
    ),
    "severity_distribution": _q(
        STORE, f"SELECT severity, max_by(n, t) AS count FROM ({_grid(300, 60, 'TRUE', 'severity')}) GROUP BY severity"
    ),
    "label_values": _q(
        STORE,
        """SELECT DISTINCT 'service' AS label, service AS value FROM store
           UNION ALL SELECT DISTINCT 'severity', severity FROM store UNION ALL SELECT DISTINCT 'topic', topic FROM store""",
    ),
    "labels": _q(
        STORE,
        " UNION ALL ".join(
            f"SELECT '{c}' AS label, count(DISTINCT {c}) AS values, count({c}) AS lines FROM store"
            for c in ("source", "topic", "service", "severity")
        ),
    ),
    "p95_latency": _q(
        EVENTS + METRICS,
        f"SELECT {_bucket(10)}, service, round(quantile_cont(lat, 0.95), 9) AS p95 FROM flags GROUP BY ALL",
    ),
    "metric_series": _q(
        EVENTS + METRICS,
        f"""SELECT {_bucket(1)}, service, round(avg(cpu), 9) AS avg_cpu_percent, round(max(cpu), 9) AS max_cpu_percent,
            round(avg(mem), 9) AS avg_memory_percent, round(max(mem), 9) AS max_memory_percent FROM flags GROUP BY ALL""",
    ),
    "anomaly_score_series": _q(
        EVENTS + ML,
        f"""SELECT {_bucket(5)}, service, round(avg(anomaly_score), 9) AS avg_anomaly_score,
            round(max(anomaly_score), 9) AS max_anomaly_score FROM ml GROUP BY ALL""",
    ),
    "retention": _q(
        EVENTS,
        """SELECT seq, CAST(CAST(happened_at AS DATE) AS VARCHAR) AS dt FROM ev
           WHERE happened_at >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 168 HOURS""",
    ),
    "parse_timestamps": _q(
        EVENTS,
        """SELECT seq, CASE seq % 5 WHEN 0 THEN timestamp WHEN 1 THEN strftime(tm, '%Y-%m-%dT%H:%M:%S.%f+00:00')
                       WHEN 2 THEN CAST(sec * 1000 AS VARCHAR) WHEN 3 THEN CAST(sec AS VARCHAR) ELSE 'not a time' END AS text,
                  CASE WHEN seq % 5 < 4 THEN sec * 1000000 END AS micros FROM ev""",
    ),
    "topic_round_trip": _q(
        LOGS,
        """SELECT 'logs_raw' AS topic, timestamp, service, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'Warning'
                  WHEN 'purchase' THEN 'DEBUG' WHEN 'view' THEN 'INFO' END AS level, message, trace_id
           FROM logs JOIN (SELECT seq, event_type FROM ev) USING (seq)""",
    ),
    "malformed_split": _q(
        LOGS,
        """SELECT CASE WHEN seq % 7 = 0 THEN 'bad' ELSE 'good' END AS kind,
                  CASE seq % 7 WHEN 0 THEN 'not json ' || seq WHEN 1 THEN 'empty' ELSE trace_id END AS body,
                  count(*) AS records FROM logs GROUP BY ALL""",
    ),
}

ORACLES["stream_enrich_global"] = ORACLES["enrich_metrics_global"]
ORACLES["stream_bursts"] = ORACLES["error_bursts"]
ORACLES["stream_enrich_by_service"] = ORACLES["enrich_metrics_by_service"]
ORACLES["stream_bursts_keyed"] = ORACLES["error_bursts"]
ORACLES["stream_cooldown"] = ORACLES["intents_after_cooldown"]
ORACLES["stream_approvals"] = _q(
    PLAIN_SPIKES,
    """SELECT * EXCLUDE (sec, rsec) FROM res
       WHERE status <> 'EXPIRED' OR rsec <= (SELECT max(t) FROM (SELECT sec AS t FROM answered
             UNION ALL SELECT sec + late FROM answered WHERE said IS NOT NULL))""",
    True,
)

# The same rows, given out while they happen.
ORACLES["stream_lifecycle"] = ORACLES["remediation_lifecycle"]
ORACLES["tail_of_store"] = ORACLES["tail_errors"]
ORACLES["stream_error_count"] = ORACLES["error_count_1m"]

_SERVICE_PATTERNS = ("*", "pay*", "payments", "payments?", "o*s", "orders*", "au[st]h", "auth-*", "d", "db", "db*", "x*", "payments-with-a-long-name*")
ORACLES["service_rules"] = _q(
    KEYWORDS,
    f"""SELECT seq, service, lower(incident_type) || '-' || pattern AS rule_id, n AS cooldown_sec
        FROM kw, (VALUES {_values(list(enumerate(_SERVICE_PATTERNS)))}) AS r(n, pattern)
        WHERE service GLOB pattern AND severity IN ('warn', 'error', 'critical')""",
)
ORACLES["store_retention"] = _q(
    LOGS,
    f"""SELECT seq, severity, strftime(happened_at, {ISO}) AS timestamp, CAST(CAST(happened_at AS DATE) AS VARCHAR) AS dt
        FROM logs JOIN (SELECT seq, happened_at FROM ev) USING (seq)
        WHERE date_trunc('second', happened_at) >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 168 HOURS""",
)
ORACLES["p95_latency_sketched"] = _q(
    EVENTS + METRICS, f"SELECT {_bucket(60)}, service, count(*) AS n, TRUE AS close FROM flags WHERE lat IS NOT NULL GROUP BY ALL"
)
ORACLES["two_topics"] = _q(
    LOGS + ML,
    """SELECT 'logs_parsed' AS topic, service, severity AS kind, timestamp FROM logs
       UNION ALL SELECT 'ml_output', service, anomaly_type, timestamp FROM ml""",
)
ORACLES["stream_restart"] = ORACLES["topic_round_trip"] + " WHERE seq % 4 <> 0"

# The life of each action, event by event.
ORACLES["approval_repeats"] = _q(
    PLAIN_SPIKES
    + f""",
asked AS (
  SELECT action_id, CASE WHEN action_id[3] BETWEEN '0' AND '3' THEN 'REBOOT' ELSE action_type END AS action_type, target_service, sec, seq
  FROM emitted),
happening AS (
  SELECT action_id, sec, seq, 'ask' AS what FROM asked
  UNION ALL SELECT action_id, sec + 300, seq + 300000000, 'ask' FROM asked WHERE action_id[4] BETWEEN '0' AND '9'
  UNION ALL SELECT action_id, sec + 2000, seq + 2000000000, 'ask' FROM asked WHERE action_id[4] BETWEEN '5' AND 'd'
  UNION ALL SELECT action_id, sec + late, seq, said FROM answered WHERE said IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY action_id ORDER BY sec, seq) AS k FROM happening),
life AS (
  SELECT action_id, 0::BIGINT AS k, NULL::BIGINT AS until, NULL::BIGINT AS done, NULL::BIGINT AS expired, NULL::VARCHAR AS status, NULL::BIGINT AS moment
  FROM asked
  UNION ALL
  SELECT action_id, k,
         CASE WHEN what = 'ask' AND NOT blocked THEN sec + 900 WHEN what = 'ask' THEN waiting END,
         CASE WHEN what <> 'ask' AND waiting IS NOT NULL THEN sec ELSE ended END,
         expired,
         CASE WHEN what = 'ask' AND NOT blocked THEN 'PENDING_APPROVAL'
              WHEN what <> 'ask' AND waiting IS NOT NULL THEN CASE WHEN what = 'EXECUTED' AND action_type = 'REBOOT' THEN 'FAILED' ELSE what END END,
         sec
  FROM (SELECT *, ended IS NOT NULL AND sec - ended <= 600 AS blocked
        FROM (SELECT n.*, a.action_type, CASE WHEN n.sec >= l.until THEN l.until END AS expired,
                     CASE WHEN n.sec < l.until THEN l.until END AS waiting,
                     CASE WHEN n.sec >= l.until THEN l.until WHEN n.sec - l.done <= 600 THEN l.done END AS ended
              FROM life l JOIN numbered n ON n.action_id = l.action_id AND n.k = l.k + 1 JOIN asked a ON a.action_id = l.action_id))),
happened AS (
  SELECT action_id, status, moment FROM life WHERE status IS NOT NULL
  UNION ALL SELECT action_id, 'EXPIRED', expired FROM life WHERE expired IS NOT NULL
  UNION ALL SELECT action_id, 'EXPIRED', until FROM (SELECT action_id, max_by(coalesce(until, -1), k) AS until FROM life GROUP BY action_id) WHERE until >= 0)""",
    f"""SELECT action_id, action_type, status,
               CASE status WHEN 'EXECUTED' THEN CASE action_type {_MESSAGE} END WHEN 'FAILED' THEN 'Unsupported action_type: ' || action_type
                           WHEN 'PENDING_APPROVAL' THEN 'Awaiting human approval' WHEN 'DENIED' THEN 'Denied by approver'
                           ELSE 'Approval timeout (900s) exceeded' END AS message,
               CAST(moment AS BIGINT) * 1000 AS ts, CASE WHEN status IN ('EXECUTED', 'FAILED') THEN action_type END AS executed_action,
               CASE WHEN status = 'DENIED' THEN 'operator' END AS approver
        FROM happened JOIN asked USING (action_id)""",
    True,
)
