import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import exact_dedup
from tidewatch.llm.exact_dedup import drop_exact_copies, duplicate_groups, filter_blocks, probe, repeated_filter
from tidewatch.llm.sharding import rendezvous, shard_documents, write_shards


def order(i):
    return (i is not None, i or 0)


@pytest.fixture(params=["sized", "one block", "many blocks", "joined"])
def blocks(request, monkeypatch):
    """Filters of several sizes; the last one is joined by block."""
    if request.param == "joined":
        monkeypatch.setattr(exact_dedup, "BROADCAST_BYTES", 0)
    return {"sized": None, "one block": 1, "many blocks": 4096, "joined": 7}[request.param]


def test_groups_equal_brute_force(awkward, rows, blocks):
    got = duplicate_groups(awkward, blocks=blocks).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max(ids, key=order)
        sha = hashlib.sha256(t.encode()).hexdigest()
        for k, i in enumerate(sorted(ids, key=order, reverse=True)):
            want[i, keep, len(ids), k == 0, sha] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == want


def test_one_row_of_each_text_stays(awkward, rows, blocks):
    left = drop_exact_copies(awkward, blocks=blocks)
    assert left.columns == awkward.columns
    best = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", (False, 0)), order(i))
    assert Counter((order(r.doc_id), r.text or "") for r in left.collect()) == Counter((i, t) for t, i in best.items())
    assert left.filter("keep_id <> 'own keep_id'").isEmpty()


def test_wholly_equal_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a", "x")] * 5 + [(1, "a", "y"), (2, "b", "z")], "doc_id long, text string, extra string")
    assert sorted(r.doc_id for r in drop_exact_copies(df).collect()) == [1, 2]


def test_filter_knows_every_repeated_hash(spark):
    rows = spark.range(5000).select("id", F.xxhash64((F.col("id") / 2).cast("long") * (F.col("id") % 3 + 1)).alias("h")).checkpoint()
    twice = {r.h for r in rows.groupBy("h").count().filter("count > 1").collect()}
    found = probe(rows, repeated_filter(rows, 4096), 4096).filter("maybe").collect()
    assert twice and twice <= {r.h for r in found}
    assert len(found) < 1.02 * sum(1 for r in rows.collect() if r.h in twice) + 5


def test_most_unique_rows_pass_at_any_number(spark):
    """Also with more rows than a filter of one or sixteen blocks could tell apart."""
    for n in (3_000, 400_000):
        rows = spark.range(n).select(F.xxhash64(F.greatest("id", F.lit(n // 10))).alias("h")).checkpoint()
        blocks = filter_blocks(n)
        maybe = probe(rows, repeated_filter(rows, blocks), blocks).filter("maybe").count()
        assert n // 10 < maybe < n // 10 + 0.06 * n
    assert filter_blocks(0) == 1 and filter_blocks(10**9) * exact_dedup.BITS >= 10**10


def test_a_hot_row_and_a_hot_text(spark):
    rows = [(1, "same", "x")] * 2000 + [(i, "same", "x") for i in range(2000)] + [(i, f"own {i}", "x") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string").repartition(6)
    assert Counter((r.doc_id, r.text) for r in drop_exact_copies(df).collect()) == Counter([(1999, "same"), *((i, f"own {i}") for i in range(500))])
    got = duplicate_groups(df)
    assert got.filter("kept").count() == 501 and got.agg(F.max("group_size")).first()[0] == 4000


def test_empty_tables(empty):
    assert duplicate_groups(empty).isEmpty()
    assert drop_exact_copies(empty).isEmpty()
    assert shard_documents(empty, {0: 1.0}).isEmpty()


def test_shards(awkward, rows):
    even = {s: 1.0 for s in range(17)}
    got = shard_documents(awkward, {s: even[s] for s in range(16)}, even).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    of_key = {}
    slots = defaultdict(list)
    for r in got:
        assert of_key.setdefault(r.doc_id, r.shard) == r.shard
        assert r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def xxh64_of(key, shard):
    """What Spark's hash of (long, int) is: the second value hashed with the first one's hash as its seed."""
    import struct

    from xxhash import xxh64_intdigest

    return xxh64_intdigest(struct.pack("<i", shard), xxh64_intdigest(struct.pack("<q", key), 42))


def slow_shard(key, weights):
    scores = {s: -math.log(((xxh64_of(key, s) >> 12) + 0.5) / 2**52) / w for s, w in weights.items()}
    return min(scores, key=lambda s: (scores[s], s))


def test_every_key_is_where_its_best_draw_is(spark):
    even, uneven = dict.fromkeys(range(16), 1.0), {0: 1.0, 3: 2.5, 4: 0.25, 9: 1.0}
    keys = [*range(-50, 3000), 2**62, -(2**62)]
    df = spark.createDataFrame([(k, "t") for k in keys], "doc_id long, text string")
    got = {r.doc_id: (r.shard, r.grown_shard) for r in shard_documents(df, even, {**even, 16: 1.0}).collect()}
    assert got == {k: (slow_shard(k, even), slow_shard(k, {**even, 16: 1.0})) for k in keys}
    assert {r.doc_id: r.shard for r in shard_documents(df, uneven).collect()} == {k: slow_shard(k, uneven) for k in keys}


def test_one_more_shard_takes_its_share_only(spark):
    n = 20_000
    moved = spark.range(n).select(rendezvous(F.col("id"), dict.fromkeys(range(9), 1.0)).alias("a"), rendezvous(F.col("id"), dict.fromkeys(range(10), 1.0)).alias("b"))
    counts = {(r.a, r.b): r["count"] for r in moved.groupBy("a", "b").count().collect()}
    changed = sum(k for (a, b), k in counts.items() if a != b)
    assert all(b == 9 for a, b in counts if a != b)
    assert abs(changed / n - 0.1) < 0.01


def test_weights_set_the_shares(spark):
    n = 30_000
    placed = spark.range(n).select(rendezvous(F.col("id"), {0: 1.0, 1: 2.0, 7: 3.0}).alias("s")).groupBy("s").count()
    share = {r.s: r["count"] / n for r in placed.collect()}
    assert all(abs(share[s] - w / 6) < 0.015 for s, w in {0: 1, 1: 2, 7: 3}.items())
    with pytest.raises(ValueError):
        rendezvous(F.lit(1), {0: 0.0})


def test_shards_are_written_as_folders(spark, awkward, tmp_path):
    write_shards(awkward, str(tmp_path / "out"), {0: 1.0, 1: 1.0})
    assert spark.read.parquet(str(tmp_path / "out")).count() == awkward.count()
