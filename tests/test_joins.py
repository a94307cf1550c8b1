"""Joins and multisets when a few keys own most rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import joins as J
from tidewatch.operators.lifecycle import match_by_keys


@pytest.fixture
def many_partitions(spark):
    """Shuffles of 16 partitions that are left as they are."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(old, ("16", "false", "-1"), strict=True):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_size_of_rows(spark):
    df = spark.createDataFrame([("x" * 1000, 1, [1, 2]), (None, None, None)], "a string, b long, c array<int>")
    assert J.is_small(df, 1100) and not J.is_small(df, 1000)
    assert J.is_small(df.filter("false"), 0)


@pytest.mark.parametrize("hot", ["found", "not found", "null"])
def test_a_popular_key_spreads_over_tasks(spark, many_partitions, hot):
    key = {"found": "k1", "not found": "zz", "null": None}[hot]
    rows = [(i, key if i % 3 == 0 else f"k{i % 997}") for i in range(6000)]
    table = [(f"k{i}", i) for i in range(500)]
    left = spark.createDataFrame(rows, "id long, k string").repartition(8).checkpoint()
    right = spark.createDataFrame(table, "_key string, v long")
    found = J.hot_values(left, [F.col("k")])
    out = J.look_up(left, F.col("k"), right, found, F.col("id"))
    known = dict(table)
    assert {(r.id, r.k, r.v) for r in out.collect()} == {(i, k, known.get(k)) for i, k in rows}
    assert out.columns == ["id", "k", "v"]
    assert largest_share(out) < 0.2


def test_no_key_of_a_row_meets_the_filler_of_another(spark):
    rows = [(1, None), (2, "1"), (3, "3")]
    left = spark.createDataFrame(rows, "id long, k string").checkpoint()
    right = spark.createDataFrame([("1", 10), ("3", 30)], "_key string, v long")
    for hot in (left.sparkSession.createDataFrame([], "place int, _key string"), J.hot_values(left, [F.col("k")])):
        out = J.look_up(left, F.col("k"), right, hot, F.col("id"))
        assert {(r.id, r.v) for r in out.collect()} == {(1, None), (2, 10), (3, 30)}


def test_fallback_keys_of_a_popular_record(spark, many_partitions):
    rng = random.Random(2)
    rows = [(i, "i7" if i % 3 == 0 else None, rng.choice(["t1", "t2", f"t{i}", None])) for i in range(3000)]
    right = [(f"i{i}", f"t{i % 40}") for i in range(200)]
    left = spark.createDataFrame(rows, "id int, a string, b string").repartition(8).checkpoint()
    out = match_by_keys(left, spark.createDataFrame(right, "i string, t string"), [("a", "i"), ("b", "t")], "id", "i")
    by_test = {}
    for i, t in right:
        by_test[t] = min(by_test.get(t, i), i)
    want = {i: (a, 1) if a else (by_test[b], 2) if b in by_test else (None, None) for i, a, b in rows}
    assert {r.id: (r.matched, r.matched_by) for r in out.collect()} == want
    assert largest_share(out) < 0.2


def multiset(rows, picked):
    have, want = Counter(rows), Counter(picked)
    return want & have, have - want


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("copies", [False, True])
def test_rows_are_picked_as_often_as_asked(spark, monkeypatch, small, copies):
    if not small:
        monkeypatch.setattr(J, "is_small", lambda df, max_bytes=0: False)
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(40)) for _ in range(400)] if copies else [("a", i) for i in range(200)]
    picked = [k for k, n in Counter(rows).items() for _ in range(rng.randrange(n + 1))] + [("zz", 1)]
    df = spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate(rows)], "k string, n long, id long").repartition(7).checkpoint()
    taken, rest = J.picked_and_rest(df, spark.createDataFrame(picked, "k string, n long"), ["k", "n"])
    took, left = taken.collect(), rest.collect()
    want, stay = multiset(rows, picked)
    assert Counter((r.k, r.n) for r in took) == want and Counter((r.k, r.n) for r in left) == stay
    assert sorted(r.id for r in took + left) == list(range(len(rows)))
    assert taken.columns == rest.columns == ["k", "n", "id"]


def test_null_keys_are_not_picked(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, id long").checkpoint()
    taken, rest = J.picked_and_rest(df, spark.createDataFrame([("a",), (None,)], "k string"), ["k"])
    assert [r.id for r in taken.collect()] == [2] and [r.id for r in rest.collect()] == [1]


def test_copies_of_one_record_spread_over_tasks(spark, many_partitions):
    rows = [("hot", 0) if i % 3 == 0 else ("cold", i) for i in range(9000)]
    df = spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate(rows)], "k string, n long, id long").repartition(12).checkpoint()
    picked = spark.createDataFrame([("hot", 0)] * 1000 + [("cold", 1)], "k string, n long")
    taken, rest = J.picked_and_rest(df, picked, ["k", "n"])
    assert taken.filter("k = 'hot'").count() == 1000 and taken.count() == 1001 and rest.count() == 9000 - 1001
    assert largest_share(rest) < 0.2
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
