"""Distributed ordered operators equal a plain sequential fold on random traces, hot keys included."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import at
from tidewatch.operators.blocks import last_known, number_rows, rolling, running_total, sorted_blocks, unplaced
from tidewatch.operators.bursts import all_incidents, burst_fires, detect_bursts, trailing_count
from tidewatch.operators.folds import block_fold
from tidewatch.operators.remediation import apply_cooldown, dedup_ttl
from tidewatch.operators.spacing import greedy_spacing


def trace(seed, n=400, span=1500, keys=("hot", "hot", "hot", "b", "c")):
    """Rows (key, second, id) in event order; most belong to one key."""
    rng = random.Random(seed)
    rows = [(rng.choice(keys), rng.randrange(span), i) for i in range(n)]
    return sorted(rows, key=lambda r: (r[1], r[2]))


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, p bigint, id bigint")


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("blocks", [1, 9])
def test_rolling_equals_a_bounded_list(spark, keys, blocks):
    rows = trace(1)
    df = frame(spark, rows).withColumn("v", (F.col("id") * 37 % 101).cast("double"))
    out = rolling(df, keys, ["p", "id"], {"v": ["avg", "max", "min", "size"]}, 5, blocks)
    got = {r.id: (r.v_avg, r.v_max, r.v_min, r.v_size) for r in out.collect()}
    last, want = {}, {}
    for k, _, i in rows:
        recent = last.setdefault(k if keys else None, [])
        recent.append(float(i * 37 % 101))
        del recent[:-5]
        want[i] = (sum(recent) / len(recent), max(recent), min(recent), len(recent))
    assert got == want


def test_rolling_window_longer_than_a_block(spark):
    rows = [("a", i, i) for i in range(40)]
    df = frame(spark, rows).withColumn("v", F.col("id").cast("double"))
    out = rolling(df, ["k"], ["p", "id"], {"v": ["avg", "size"]}, 25, blocks=10)
    got = {r.id: (r.v_avg, r.v_size) for r in out.collect()}
    assert got == {i: (sum(range(max(0, i - 24), i + 1)) / min(i + 1, 25), min(i + 1, 25)) for i in range(40)}


def test_number_rows_and_lag(spark):
    rows = trace(2)
    out = number_rows(frame(spark, rows), ["k"], ["p", "id"], lag_of="p", lag=3, blocks=8)
    got = {r.id: (r.rn, r.lagged) for r in out.collect()}
    seen, want = {}, {}
    for k, p, i in rows:
        s = seen.setdefault(k, [])
        s.append(p)
        want[i] = (len(s), s[-4] if len(s) > 3 else None)
    assert got == want


def test_running_total(spark):
    rows = trace(3)
    df = frame(spark, rows).withColumn("w", F.col("id") % 7)
    got = {r.id: r.total for r in running_total(df, ["k"], ["p", "id"], "w", "total", 8).collect()}
    sums, want = {}, {}
    for k, _, i in rows:
        sums[k] = sums.get(k, 0) + i % 7
        want[i] = sums[k]
    assert got == want


@pytest.mark.parametrize("gap", [0, 1, 7, 60, 700])
@pytest.mark.parametrize("max_steps", [1000, 1])
def test_greedy_spacing(spark, gap, max_steps):
    rows = trace(gap, span=600)
    out = greedy_spacing(frame(spark, rows), ["k"], "p", ["id"], gap, blocks=9, max_steps=max_steps)
    last, want = {}, set()
    for k, p, i in rows:
        if k not in last or p >= last[k] + gap:
            last[k] = p
            want.add(i)
    assert {r.id for r in out.collect()} == want


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_long_step_functions_are_composed_in_few_jobs(spark):
    """One hot key whose functions stay in a table: the jobs grow with the logarithm of the blocks."""
    rows = [("hot", 3 * i + i % 2, i) for i in range(3000)] + [("z", i, 5000 + i) for i in range(40)]
    counts = {}
    for blocks in (6, 12, 24):
        found = []
        counts[blocks] = jobs_of(spark, f"spacing-{blocks}", lambda blocks=blocks, found=found: found.extend(
            greedy_spacing(frame(spark, rows), ["k"], "p", ["id"], 100, blocks=blocks, max_steps=1).collect()
        ))
        want, last = [], {}
        for k, p, i in rows:
            if k not in last or p >= last[k] + 100:
                want.append(i)
                last[k] = p
        assert sorted(r.id for r in found) == sorted(want)
    assert counts[24] - counts[12] <= counts[12] - counts[6] + 6 and counts[24] < 2 * counts[12]


@pytest.mark.parametrize("blocks", [1, 7, 40])
def test_last_known_value(spark, blocks):
    rows = [(k, p, i, i * 10 if i % 9 == 0 else None) for k, p, i in trace(6)] + [("never", 1, -5, None)]
    df = spark.createDataFrame(rows, "k string, p bigint, id bigint, v bigint")
    got = {r.id: r.w for r in last_known(df, ["k"], ["p", "id"], "v", "w", blocks).collect()}
    known, want = {}, {}
    for k, _, i, v in rows:
        known[k] = known.get(k) if v is None else v
        want[i] = known[k]
    assert got == want


def test_step_functions_of_a_hot_key_spread_over_tasks(spark):
    """Steps that never meet stay as many as positions; composed, no block of them holds a large share."""
    from tidewatch.operators.spacing import _composed

    n = 4000
    steps = [(0, b, b * n + i, b * n + n - 1 - (n - 1 - i) % 7, b * n + 7) for b in range(2) for i in range(n)]
    frame_of = spark.createDataFrame(steps, "chain long, idx long, upper long, last long, bound long")
    out = _composed(frame_of, {0: 7}, 8).checkpoint()
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and len(sizes) >= 4 and max(sizes) < n / 2
    right = [(u, e) for _, b, u, e, _ in steps if b == 1]
    for r in out.sample(0.02, seed=1).collect():
        at = next(e for c, b, u, e, _ in steps if b == 0 and u == r.upper) + 7
        assert r["last"] == next(e for u, e in right if u >= at)


def test_greedy_spacing_where_chains_never_meet(spark):
    rows = [("a", i, i) for i in range(300)]
    out = greedy_spacing(frame(spark, rows), ["k"], "p", ["id"], 7, blocks=12)
    assert sorted(r.id for r in out.collect()) == list(range(0, 300, 7))


def test_empty_inputs(spark):
    empty = frame(spark, [])
    assert greedy_spacing(empty, ["k"], "p", ["id"], 5).count() == 0
    assert number_rows(empty, ["k"], ["p", "id"]).count() == 0
    assert rolling(empty, [], ["p", "id"], {"id": ["avg"]}, 5).count() == 0


def test_hot_key_spreads_over_blocks(spark):
    rows = [("a", i, i) for i in range(1000)]
    blocks = sorted_blocks(frame(spark, rows), ["k"], ["p", "id"], 8)
    sizes = [r["count"] for r in blocks.groupBy("_block").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 400


def test_block_fold_equals_a_plain_fold(spark):
    rows = trace(4)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.LongType())])

    def step(state, row):
        # Remembers far back, so the blocks of the hot key cannot settle in one round.
        state["s"] = (state.get("s", 1) * 3 + row["id"]) % 1_000_003
        return [{"id": row["id"], "s": state["s"]}]

    def finish(state):
        return [{"id": -1, "s": state["s"]}]

    out = block_fold(frame(spark, rows), ["k"], ["p", "id"], step, finish, schema, blocks=7)
    got = sorted((r.id, r.s) for r in out.collect())
    states, want = {}, []
    for k, _, i in rows:
        want += [(o["id"], o["s"]) for o in step(states.setdefault(k, {}), {"id": i})]
    want += [(-1, s["s"]) for s in states.values()]
    assert got == sorted(want)


def logs(spark, rows):
    """Error logs from (service, second, id)."""
    return spark.createDataFrame(
        [(k, "error", at(p), i) for k, p, i in rows], "service string, severity string, ts timestamp, seq bigint"
    )


def burst_fold(rows, window, threshold):
    times, fired = {}, []
    for k, p, i in rows:
        w = [t for t in times.get(k, []) if t >= p - window] + [p]
        if len(w) >= threshold:
            fired.append(i)
            w = []
        times[k] = w
    return sorted(fired)


@pytest.mark.parametrize(("threshold", "span", "n"), [(4, 1500, 400), (8, 900, 400), (3, 200, 300), (1, 100, 50)])
def test_bursts_equal_the_sequential_rule(spark, threshold, span, n):
    rows = trace(threshold, n, span)
    got = sorted(r.seq for r in burst_fires(logs(spark, rows), 30, threshold).collect())
    want = burst_fold(rows, 30, threshold)
    assert got == want and want


def test_trailing_count(spark):
    rows = trace(6, 300, 200)
    out = trailing_count(logs(spark, rows), 30)
    got = {r.seq: r.trailing_count for r in out.collect()}
    want, seen = {}, {}
    for k, p, i in rows:
        seen.setdefault(k, []).append(p)
        want[i] = sum(t >= p - 30 for t in seen[k])
    assert got == want


def test_trailing_count_of_copies_and_unplaced_rows(spark):
    rows = [("a", 0, 1), ("a", 5, 2), ("a", 10, 3), ("a", 10, 3), ("a", 10, None), ("a", None, 4), (None, 10, 5), ("b", 10, 6)]
    df = spark.createDataFrame([(k, None if p is None else at(p), i) for k, p, i in rows], "service string, ts timestamp, seq long")
    got = sorted(((r.service or "", r.seq or 0, r.trailing_count) for r in trailing_count(df, 30).collect()), key=str)
    want = [("", 5, None), ("a", 0, 3), ("a", 1, 1), ("a", 2, 2), ("a", 3, 4), ("a", 3, 5), ("a", 4, None), ("b", 6, 1)]
    assert got == sorted(want, key=str)


def test_bursts_of_copies_and_rows_without_time(spark):
    rows = [("a", p, p) for p in range(8)] + [("a", 7, 7), ("a", None, 99)] + [("a", 100, 100)] * 17
    df = spark.createDataFrame(
        [(k, None if p is None else at(p), i, "error", "m") for k, p, i in rows],
        "service string, ts timestamp, seq long, severity string, message string",
    )
    df = df.withColumns({"timestamp": F.lit(None).cast("string"), "original_level": F.lit("ERROR"), "trace_id": F.lit("t")})
    fires = burst_fires(df, 30, 8)
    assert sorted(r.seq for r in fires.collect()) == [7, 100, 100]
    assert sorted(r.seq for r in detect_bursts(df, 30, 8).collect()) == [7, 100, 100]
    assert [r.seq for r in unplaced(df, ["ts", "seq"]).collect()] == [99]
    keyword = df.select("service", "ts", "seq", "timestamp")
    rest = all_incidents(fires.select("service", F.timestamp_micros("_at").alias("ts"), "seq"), keyword, keyword.limit(0))
    assert rest.count() == df.count()


def test_dedup_ttl_end_is_still_a_duplicate(spark):
    df = spark.createDataFrame([("a", at(s), i) for i, s in enumerate([0, 600, 601, 1201, 1202])], "action_id string, ts timestamp, seq bigint")
    assert sorted(r.seq for r in dedup_ttl(df).collect()) == [0, 2, 4]


def candidates(spark, rows):
    """(rule, target, cooldown, second, id, action id)"""
    return spark.createDataFrame(
        [(r, t, cd, at(s), i, a, 0) for r, t, cd, s, i, a in rows],
        "rule_id string, target_service string, cooldown_sec int, ts timestamp, seq bigint, action_id string, rule_order int",
    )


def cooldown_fold(rows, ttl=600):
    free, seen, out = {}, {}, []
    for r, t, cd, s, i, a in rows:
        if s < free.get((r, t), 0) or seen.get(a, -1) >= s:
            continue
        out.append(i)
        free[r, t], seen[a] = s + max(0, cd), s + ttl
    return sorted(out)


def test_cooldown_end_is_allowed(spark):
    rows = [("r", "t", 120, s, i, f"a{i}") for i, s in enumerate([0, 119, 120, 239, 240, 400])]
    assert sorted(r.seq for r in apply_cooldown(candidates(spark, rows)).collect()) == [0, 2, 4, 5]


@pytest.mark.parametrize("cooldown", [-5, 0, 50, 120])
def test_cooldown_with_repeated_action_ids(spark, cooldown):
    rng = random.Random(cooldown)
    rows = []
    for i, s in enumerate(sorted(rng.randrange(4000) for _ in range(250))):
        rule, target = rng.choice([("r1", cooldown), ("r2", 200)]), rng.choice(["x", "x", "y"])
        action = f"{rule[0]}-{target}-{rng.randrange(12)}" if rule[0] == "r1" else f"one-{i}"
        rows.append((rule[0], target, rule[1], s, i, action))
    got = sorted(r.seq for r in apply_cooldown(candidates(spark, rows)).collect())
    assert got == cooldown_fold(rows)
