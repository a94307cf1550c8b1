"""Incidents to intents to results, with the end-to-end scenarios on small inputs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, iso
from tidewatch.operators import remediation as R
from tidewatch.operators.approvals import ApprovalMachine, ApprovalTransition, resolve_approvals, route_actions
from tidewatch.operators.bursts import all_incidents, detect_bursts
from tidewatch.operators.lifecycle import lifecycle, match_by_keys, missing
from tidewatch.operators.logs import log_incidents, normalize_logs
from tidewatch.plans.pipeline import candidates_of, intents_of, results_of
from tidewatch.schemas import LOGS_RAW
from tidewatch.functions.scalars import glob_regex
from tidewatch.sources.rulebook import PREFIX_LENGTHS, filed_prefixes, literal_prefix, load_rules

INCIDENT = (
    "incident_id string, timestamp string, service string, severity string, incident_type string, source string, "
    "details string, test_id string, trace_id string, ts timestamp, seq bigint"
)


def incident(i, service, kind="LATENCY_SPIKE", severity="error", given="inc", sec=None):
    sec = i if sec is None else sec
    given = given and f"{given}-{i}"
    return (given, iso(sec), service, severity, kind, "test", "{}", f"test-{i}", None, at(sec), i)


def incidents(spark, rows):
    return spark.createDataFrame(rows, INCIDENT)


def test_nine_errors_give_one_burst_and_no_keyword(spark):
    rows = [(iso(0), "payments", "ERROR", f"[{i}] timeout connecting to db (burst)", f"t{i}", at(0), i) for i in range(9)]
    parsed = normalize_logs(spark.createDataFrame(rows, LOGS_RAW + ", ts timestamp, seq bigint"))
    out = detect_bursts(parsed).collect()
    assert len(out) == 1
    burst = out[0]
    details = json.loads(burst.details)
    assert (burst.incident_type, burst.severity, burst.seq) == ("ERROR_RATE_SPIKE", "critical", 7)
    assert (details["count"], details["threshold"], details["window_sec"]) == (8, 8, 30)
    assert details["sample_log"]["trace_id"] == "t7"
    assert log_incidents(parsed).count() == 0


def test_burst_edge_of_window(spark):
    def fires(last):
        rows = [("a", "error", at(0), 0)] + [("a", "critical", at(last), i) for i in range(1, 8)]
        df = spark.createDataFrame(rows, "service string, severity string, ts timestamp, seq bigint")
        from tidewatch.operators.bursts import burst_fires

        return burst_fires(df).count()

    assert fires(30) == 1 and fires(30.000001) == 0


def test_burst_record_gives_no_keyword_incident(spark):
    rows = [(iso(0), "a", "ERROR", "cache miss", f"t{i}", at(0), i) for i in range(9)]
    parsed = normalize_logs(spark.createDataFrame(rows, LOGS_RAW + ", ts timestamp, seq bigint"))
    bursts, keywords = detect_bursts(parsed), log_incidents(parsed)
    out = all_incidents(bursts, keywords, keywords.limit(0))
    assert {(r.seq, r.incident_type) for r in out.collect()} == {
        (i, "ERROR_RATE_SPIKE" if i == 7 else "CACHE_STORM") for i in range(9)
    }


def test_canonicalize(spark):
    rows = [
        ("  Payment-Service ", "WARNING"), ("orders", " Error"), ("", ""), (None, None), ("other", "info"), (" ", "warn")
    ]
    df = spark.createDataFrame([(i, *r, "AUTH-service") for i, r in enumerate(rows)], "seq int, service string, severity string, target string")
    out = R.canonicalize_incidents(df, load_rules(spark).aliases).orderBy("seq").collect()
    assert [(r.service, r.severity, r._service_alias_raw, r._service_alias_canonical) for r in out] == [
        ("payments", "warn", "payment-service", "payments"),
        ("orders", "error", None, None),
        ("", "", None, None),
        (None, None, None, None),
        ("other", "info", None, None),
        (" ", "warn", None, None),
    ]
    assert {r.target for r in out} == {"auth"}


def test_rules_from_config(spark):
    book = load_rules(
        spark,
        {
            "defaults": {"severity": "error", "cooldown_sec": 7},
            "service_aliases": {" A ": "B", "": "x", "c": " "},
            "policy": {"allowlist_services": [" Web "], "denylist_services": ["bad"], "allowlist_action_types": ["GO "]},
            "rules": [
                "no mapping",
                {"rule_id": "no-type", "action_type": "GO"},
                {"rule_id": "blank", "incident_type": " ", "action_type": "GO"},
                {"rule_id": "any", "incident_type": "X", "action_type": "GO"},
                {"rule_id": "web", "incident_type": "X", "action_type": "STOP", "pattern": "we?", "min_severity": "info", "target_service": "{oops}", "cooldown_sec": 0},
            ],
        },
    )
    rules = {r.rule_id: r for r in book.rules.collect()}
    assert set(rules) == {"any", "web"}
    assert (rules["any"].min_severity, rules["any"].pattern, rules["any"].cooldown_sec) == ("error", "*", 7)
    assert rules["any"].target_service == "{service}" and rules["web"].cooldown_sec == 0
    assert [tuple(r) for r in book.aliases.collect()] == [("a", "b")]
    rows = [incident(0, "web", "X", "info"), incident(1, "web", "X", "error"), incident(2, "bad", " X ", "error"), incident(3, None, "X", None)]
    matched = R.match_rules(incidents(spark, rows), book.rules, book.default_severity)
    allowed, rejected = R.apply_policy(matched, book.policy)
    assert [(r.seq, r.rule_id, r.target_service) for r in allowed.collect()] == [(1, "any", "web")]
    assert {(r.seq, r.rule_id, r.target_service, r.reason) for r in rejected.collect()} == {
        (0, "web", "web", "action_type_not_allowed"),
        (1, "web", "web", "action_type_not_allowed"),
        (2, "any", "bad", "denylist_service"),
        (3, "any", "unknown", "not_in_allowlist"),
    }


def test_literal_beginnings():
    assert [literal_prefix(p) for p in ("abc", "ab*c", "?b", "a[bc]", "", "a[")] == ["abc", "ab", "", "a", "", "a"]
    many = ["x" * i + "*" for i in range(100)]
    cut = filed_prefixes(many)
    assert all(p.startswith(c) for p, c in zip(many, cut, strict=True)) and len({0, *map(len, cut)}) <= PREFIX_LENGTHS
    assert filed_prefixes(["*", "abc*", "ab"]) == ["", "abc", "ab"] and filed_prefixes([]) == []


def test_very_many_rules_meet_few_incidents(spark):
    """50,000 rules of one type: the same pairs as all against all, from few candidates."""
    rng = random.Random(4)
    patterns = [rng.choice([f"team{i % 97}-svc{i}*", f"team{i % 97}-svc{i}", f"team{i % 97}-s?c{i}", f"team{i % 97}-svc[0-4]{i % 1000}"]) for i in range(49_990)] + ["*", "t*", "?eam*", "[t]eam1*", "", "team5", "te*", "x*", "team", "team*"]
    config = {"rules": [{"rule_id": f"r{i}", "incident_type": "LATENCY_SPIKE", "pattern": p, "action_type": "SCALE_UP"} for i, p in enumerate(patterns)]}
    services = [f"team{i % 97}-svc{i}" for i in range(0, 49_990, 2500)] + ["", "t", "team5", "other", "team1-svc31234"]
    book = load_rules(spark, config)
    raw = incidents(spark, [incident(i, s) for i, s in enumerate(services)])
    assert 1 < len(book.prefixes) <= PREFIX_LENGTHS
    got = {(r.seq, r.rule_id) for r in R.match_rules(raw, book.rules, book.default_severity, book.prefixes).collect()}
    import re

    # Patterns in Java's spelling; \z is Python's \Z.
    compiled = [re.compile(glob_regex(p).replace(r"\z", r"\Z")) for p in patterns]
    assert got == {(n, f"r{i}") for n, s in enumerate(services) for i, c in enumerate(compiled) if patterns[i] in ("", "*") or c.search(s)}
    met = R.filed_rules(raw, book.rules, book.prefixes).count()
    assert met < len(services) * len(patterns) / 50


def test_incidents_keep_their_columns_beside_those_of_rules(spark):
    book = load_rules(spark, {"rules": [{"rule_id": "r", "incident_type": "LATENCY_SPIKE", "pattern": "pay*", "action_type": "SCALE_UP"}]})
    raw = incidents(spark, [incident(0, "payments")]).withColumns({c: F.lit(f"own {c}") for c in ("prefix", "pattern", "regex", "min_severity")})
    (row,) = R.match_rules(raw, book.rules, prefixes=book.prefixes).collect()
    assert (row.prefix, row.pattern, row.regex, row.min_severity, row.rule_id) == ("own prefix", "own pattern", "own regex", "own min_severity", "r")


def test_alias_incident_gives_one_intent(spark):
    out = intents_of(incidents(spark, [incident(0, "payment-service")]), load_rules(spark)).collect()
    assert len(out) == 1
    row = out[0]
    assert (row.target_service, row.action_type, row.status, row.rule_id) == ("payments", "SCALE_UP", "APPROVED", "latency_spike_scale_up")
    assert (row.severity, row.source, row.test_id, row.incident_id, row.correlation_id) == ("warn", "auto_remediator", "test-0", "inc-0", "inc-0")
    assert json.loads(row.incident)["_service_alias_raw"] == "payment-service"
    assert json.loads(row.parameters) == {"reason": "latency spike", "replicas_delta": 1}


def test_unknown_service_is_rejected(spark):
    allowed, rejected = candidates_of(incidents(spark, [incident(0, "unknown"), incident(1, None), incident(2, "")]), load_rules(spark))
    assert allowed.count() == 0
    assert {(r.seq, r.reason) for r in rejected.collect()} == {(0, "denylist_service"), (1, "denylist_service"), (2, "not_in_allowlist")}


def test_ids_are_stable_and_hashed_after_canonical_names(spark):
    rows = [incident(0, "payments", given=None, sec=5), incident(1, " Payment-Service", given=None, sec=5)]
    allowed, _ = candidates_of(incidents(spark, rows), load_rules(spark))
    a, b = allowed.orderBy("seq").collect()
    assert a.incident_id == b.incident_id and a.action_id == b.action_id and len(a.action_id) == 24


def test_same_target_is_cooled_down(spark):
    rows = [incident(i, "payments", sec=s) for i, s in enumerate([0, 60, 120, 200, 240])]
    out = intents_of(incidents(spark, rows), load_rules(spark)).collect()
    assert sorted(r.seq for r in out) == [0, 2, 4]


ACTION = "event_type string, action_id string, status string, action_type string, target_service string, incident_id string, ts timestamp, seq bigint"
APPROVAL = "event_type string, action_id string, decision string, approver string, ts timestamp, seq bigint"


def intent(i, sec, action="a", status="PROPOSED", kind="SCALE_UP"):
    return ("ACTION_INTENT", action, status, kind, "payments", "inc", at(sec), i)


def approval(i, sec, action="a", decision="APPROVE"):
    return ("ACTION_APPROVAL", action, decision, "op", at(sec), i)


def resolve(spark, intents, approvals, **kw):
    a, b = spark.createDataFrame(intents, ACTION), spark.createDataFrame(approvals, APPROVAL)
    out = resolve_approvals(a, b, **kw).orderBy("ts", "status").collect()
    start = int(at(0).timestamp() * 1000)
    return [(r.status, (r.ts - start) // 1000) for r in out], out


def test_approved_scenario(spark):
    got, rows = resolve(spark, [intent(0, 0)], [approval(1, 50)], as_of=4_000_000_000)
    assert got == [("PENDING_APPROVAL", 0), ("EXECUTED", 50)]
    assert rows[1].message == "Scaled up payments" and rows[1].executed_action == "SCALE_UP" and rows[1].approver is None
    assert rows[0].executed_action is None and rows[0].incident_id == "inc"


def test_approval_boundaries(spark):
    end = 4_000_000_000
    assert resolve(spark, [intent(0, 0)], [], as_of=end)[0] == [("PENDING_APPROVAL", 0), ("EXPIRED", 900)]
    assert resolve(spark, [intent(0, 0)], [])[0] == [("PENDING_APPROVAL", 0)]
    assert resolve(spark, [intent(0, 0)], [approval(1, 900)], as_of=end)[0] == [("PENDING_APPROVAL", 0), ("EXPIRED", 900)]
    got, rows = resolve(spark, [intent(0, 0)], [approval(1, 899, decision=" denied ")])
    assert got == [("PENDING_APPROVAL", 0), ("DENIED", 899)] and rows[1].approver == "op"
    # A second intent renews the wait.
    got, _ = resolve(spark, [intent(0, 0), intent(1, 800)], [approval(2, 1000)])
    assert got == [("PENDING_APPROVAL", 0), ("PENDING_APPROVAL", 800), ("EXECUTED", 1000)]
    # An intent exactly 600 s after the result is still a repeat.
    got, _ = resolve(spark, [intent(0, 0), intent(2, 610), intent(3, 611)], [approval(1, 10)])
    assert got == [("PENDING_APPROVAL", 0), ("EXECUTED", 10), ("PENDING_APPROVAL", 611)]
    # Early, malformed and anonymous approvals do nothing.
    bad = [approval(0, 0), approval(2, 5, decision="maybe"), approval(3, 6, action=None)]
    assert resolve(spark, [intent(1, 1)], bad)[0] == [("PENDING_APPROVAL", 1)]


def test_without_approval_everything_runs(spark):
    got, rows = resolve(spark, [intent(0, 0), intent(1, 10), intent(2, 5, "b", kind="DANCE"), intent(3, 1, "")], [approval(4, 3)], require_approval=False)
    assert got == [("EXECUTED", 0), ("FAILED", 5)]
    assert rows[1].message == "Unsupported action_type: DANCE"


def test_approved_intent_skips_the_wait(spark):
    assert resolve(spark, [intent(0, 0, status="APPROVED")], [])[0] == [("EXECUTED", 0)]


def test_hot_action_equals_a_plain_fold(spark):
    rng = random.Random(3)
    intents, approvals, events = [], [], []
    for i in range(300):
        action, sec = rng.choice(["a", "a", "a", "b"]), rng.randrange(60_000)
        if rng.random() < 0.6:
            status = rng.choice(["PROPOSED", "PROPOSED", "APPROVED"])
            intents.append(intent(i, sec, action, status))
            row = {"event_type": "ACTION_INTENT", "status": status, "action_type": "SCALE_UP", "target_service": "payments"}
        else:
            said = rng.choice(["APPROVE", "DENY"])
            approvals.append(approval(i, sec, action, said))
            row = {"event_type": "ACTION_APPROVAL", "decision": said, "approver": "op"}
        events.append((int(at(sec).timestamp()) * 1_000_000, i, {"action_id": action, **row}))
    out = resolve_approvals(spark.createDataFrame(intents, ACTION), spark.createDataFrame(approvals, APPROVAL), as_of=4_000_000_000)
    got = sorted((r.action_id, r.status, r.ts) for r in out.collect())
    machine, states, want = ApprovalMachine(True, 900, 600, 4_000_000_000 * 1_000_000), {}, []
    for moment, _, row in sorted(events, key=lambda e: e[:2]):
        want += machine.step(states.setdefault(row["action_id"], {}), {**row, "_at": moment})
    for s in states.values():
        want += machine.finish(s)
    assert got == sorted((r["action_id"], r["status"], r["_at"] // 1000) for r in want)


def long_life(n, seed, kinds):
    """Events of one action that never rests for long, with ties."""
    rng = random.Random(seed)
    intents, approvals, events, sec = [], [], [], 0
    for i in range(n):
        sec += rng.choice([0, 5, 60, 400, 700])
        kind = rng.choice(kinds)
        if kind in ("PROPOSED", "APPROVED"):
            intents.append(intent(i, sec, "hot", kind))
            row = {"event_type": "ACTION_INTENT", "status": kind, "action_type": "SCALE_UP", "target_service": "payments"}
        else:
            approvals.append(approval(i, sec, "hot", kind))
            row = {"event_type": "ACTION_APPROVAL", "decision": kind, "approver": "op"}
        events.append({"action_id": "hot", "_at": int(at(sec).timestamp()) * 1_000_000, **row})
    machine, state, want = ApprovalMachine(True, 900, 600), {}, []
    for row in events:
        want += machine.step(state, row)
    return intents, approvals, sorted((r["status"], r["_at"] // 1000) for r in want)


@pytest.mark.parametrize("kinds", [("PROPOSED", "APPROVE", "DENY"), ("APPROVED",), ("PROPOSED", "PROPOSED", "APPROVED", "APPROVE", "DENY")])
def test_one_long_action_over_many_blocks(spark, kinds):
    intents, approvals, want = long_life(1500, 7, kinds)
    a, b = spark.createDataFrame(intents, ACTION), spark.createDataFrame(approvals or [approval(0, 0, None)], APPROVAL)
    out = resolve_approvals(a, b, blocks=64)
    assert sorted((r.status, r.ts) for r in out.collect()) == want


@pytest.mark.parametrize("kinds", [("PROPOSED", "APPROVE", "DENY"), ("PROPOSED", "PROPOSED", "APPROVED", "APPROVE", "DENY")])
def test_jobs_do_not_grow_with_the_blocks_of_one_action(spark, kinds):
    intents, approvals, want = long_life(1500, 8, kinds)
    a, b = spark.createDataFrame(intents, ACTION), spark.createDataFrame(approvals, APPROVAL)
    jobs = {}
    for blocks in (4, 16, 64):
        spark.sparkContext.setJobGroup(f"approvals-{len(kinds)}-{blocks}", "")
        assert resolve_approvals(a, b, blocks=blocks).count() == len(want)
        jobs[blocks] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"approvals-{len(kinds)}-{blocks}"))
    spark.sparkContext.setJobGroup("", "")
    assert jobs[64] <= jobs[4] + 1


def test_functions_of_events_equal_the_machine():
    """The state that a function gives and the one the machine ends in lead to the same results from then on."""
    for seed in range(3000):
        rng = random.Random(seed)
        machine = ApprovalMachine(rng.random() < 0.85, rng.choice([0, 3, 9, 20]), rng.choice([0, 2, 6, 15]))
        kinds = rng.choice([("PROPOSED", "APPROVE", "DENY"), ("PROPOSED", "APPROVED", "APPROVE", "DENY"), ("APPROVED",), ("PROPOSED", "APPROVED")])
        now, rows = 10**8, []
        for _ in range(rng.randrange(2, 40)):
            now += rng.randrange(rng.choice([2, 3, 13])) * 10**6
            kind = rng.choice(kinds)
            intended = kind in ("PROPOSED", "APPROVED")
            rows.append({"action_id": "a", "event_type": "ACTION_INTENT" if intended else "ACTION_APPROVAL", "status": kind if intended else None,
                         "decision": None if intended else kind, "action_type": "SCALE_UP", "rule_id": str(len(rows)), "_at": now})
        cut, state = rng.randrange(1, len(rows)), {}
        for row in rows[:cut]:
            machine.step(state, row)
        functions = ApprovalTransition(machine)
        got = functions.apply(json.loads(json.dumps(functions.summarize(rows[cut:]))), json.loads(json.dumps(state)))
        for row in rows[cut:]:
            machine.step(state, row)

        def live(s, now=now, machine=machine):
            return {k: v for k, v in s.items() if k != "done" or now - v <= machine.dedup_us}

        assert live(got) == live(json.loads(json.dumps(state)))


def test_routing(spark):
    df = spark.createDataFrame([("ACTION_INTENT",), ("ACTION_APPROVAL",), ("ACTION_RESULT",), (None,)], "event_type string")
    a, b = route_actions(df)
    assert (a.count(), b.count()) == (1, 1)


def test_lifecycle(spark):
    raw = incidents(spark, [incident(0, "payment-service"), incident(1, "unknown")])
    intents = intents_of(raw, load_rules(spark), require_approval=True).checkpoint()
    approvals = intents.select(
        F.lit("ACTION_APPROVAL").alias("event_type"), "action_id", F.lit("yes").alias("decision"), F.lit("op").alias("approver"),
        (F.col("ts") + F.expr("INTERVAL 30 SECONDS")).alias("ts"), "seq",
    )
    results = results_of(intents, approvals)
    out = {r.incident_id: r for r in lifecycle(raw, intents, results).collect()}
    assert (out["inc-0"].terminal_status, out["inc-0"].sec_to_intent, out["inc-0"].sec_to_terminal) == ("EXECUTED", 0.0, 30.0)
    assert out["inc-0"].pending_at is not None
    assert out["inc-1"].action_id is None and out["inc-1"].terminal_status is None


def test_match_by_keys_prefers_the_first_pair(spark):
    left = spark.createDataFrame([(1, "i1", "t2"), (2, None, "t2"), (3, "zz", "t1"), (4, None, None)], "id int, a string, b string")
    right = spark.createDataFrame([("i1", "t1"), ("i2", "t2"), ("i3", "t2")], "i string, t string")
    out = match_by_keys(left, right, [("a", "i"), ("b", "t")], "id", "i")
    assert {r.id: (r.matched, r.matched_by) for r in out.collect()} == {1: ("i1", 1), 2: ("i2", 2), 3: ("i1", 2), 4: (None, None)}


def test_missing(spark):
    required = spark.createDataFrame([("a",), ("b",)], "topic string")
    seen = spark.createDataFrame([("a",), ("a",), ("c",)], "topic string")
    assert [r.topic for r in missing(required, seen, "topic").collect()] == ["b"]
