import contextlib
import hashlib
import os
import threading
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import with_clashes
from tidewatch.llm.embedding_dedup import embedding_classes, forest, linked, tile_pairs, tiles
from tidewatch.llm.filter_audit import audit_filters, shapley_operator, solved
from tidewatch.llm.merkle import manifest, proof_digest
from tidewatch.session import shared_dir

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in SPACE[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


# ---- filter audit ----


def slow_audit(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic). Every order is run document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    ids = defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            ids[t or ""].append(i)
    docs = defaultdict(list)
    for i, t, s in rows:
        text = t or ""
        w = words_of(text)
        fails = ""
        fails += "A" if len(w) < 200 else ""
        fails += "B" if 100 * len(set(w)) < 50 * len(w) else ""
        fails += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text) else ""
        fails += "D" if any(c in "#$%&*|" for c in text) else ""
        fails += "E" if i is not None and min(ids[text]) < i else ""
        docs[s or ""].append((i, fails))
    out = {}
    for part, found in docs.items():
        share = Counter()
        steps = []
        for order in permutations("ABCDE"):
            left = found
            for k, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                share[f] += len(gone)
                failing = sum(f in d[1] for d in found)
                steps.append((("".join(order), k), f, len(left), len(gone), failing - len(gone), sum(d[1] == f for d in found), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)))
        for key, f, *counts in steps:
            out[part, *key] = (*counts, share[f])
    return out


def audited(df, labels):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in audit_filters(df, labels).collect()}


def test_audit_equals_running_every_order(spark, awkward):
    rows = [(r.doc_id, r.text, r.source) for r in awkward.select("doc_id", "text", "source").collect()]
    marks = [(1, 1, 0), (1, 0, 1), (2, 0, 1), (8, 1, 1), (11, None, 1), (None, 1, 1), (99, 1, 1), (16, 1, None), (12, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = audited(awkward, labels)
    assert got == slow_audit(rows, marks)
    assert len(got) == 600 * len({r[2] or "" for r in rows})


def test_audit_of_the_small_table(spark, documents, table):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    marks = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    assert audited(documents, labels) == slow_audit([(r["doc_id"], r["text"], r["source"]) for r in table], marks)


def test_audit_with_many_copies_and_without_rows(spark, empty):
    rows = [(i, "SAME $ text", "hot") for i in range(3000)] + [(5, "SAME $ text", "other")] * 3 + [(None, "SAME $ text", None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(df, none) == slow_audit(rows, [])
    assert audit_filters(empty, none).isEmpty()


def test_text_keys_and_other_names(spark):
    df = spark.createDataFrame([("a", "x y", "s"), ("b", "x y", "s"), ("b", None, None)], "key string, body string, host string")
    none = spark.createDataFrame([], "key string, quality int, toxic int")
    got = audit_filters(df, none, "key", "body", "host").filter("filter_order = 'EABCD' AND step = 1")
    assert {(r.part, r.kept, r.removed) for r in got.collect()} == {("s", 1, 1), ("", 1, 0)}


def test_least_squares_give_shapley_values():
    operator = shapley_operator(4)
    rng = np.random.default_rng(3)
    worth = [0, *map(int, rng.integers(-50, 50, 15))]
    want = [Fraction(0)] * 4
    for order in permutations(range(4)):
        done = 0
        for i in order:
            want[i] += Fraction(worth[done | 1 << i] - worth[done], 24)
            done |= 1 << i
    assert [sum(c * w for c, w in zip(row, worth, strict=True)) for row in operator] == want
    assert solved([[Fraction(0), Fraction(2)], [Fraction(1), Fraction(1)]], [[Fraction(4)], [Fraction(5)]]) == [[3], [2]]


# ---- Merkle manifest ----


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def slow_tree(leaves):
    """(root, for each leaf the (before, after) of every step)"""
    steps = [[] for _ in leaves]
    at = list(range(len(leaves)))
    level = leaves
    while len(level) > 1:
        for k in range(len(leaves)):
            run = at[k] // 16 * 16
            steps[k].append((level[run : at[k]], level[at[k] + 1 : run + 16]))
            at[k] //= 16
        level = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
    return level[0], steps


def slow_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] if r[0] is not None else 0, leaf_of(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        trees[s] = slow_tree([x[2] for x in groups[s]])
    root, above = slow_tree([trees[s][0] for s in names])
    out = Counter()
    for s, up in zip(names, above, strict=True):
        for (_, _, leaf, r), own in zip(groups[s], trees[s][1], strict=True):
            steps = own + up
            at = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                at = leaf_of((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for before, after in steps:
                at = sha("".join(before) + at + "".join(after))
            proof = sha("".join(x for step in steps for side in step for x in side))
            out[r[0], leaf, trees[s][0], root, proof, at, at == root] += 1
    return out


def digested(df):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return Counter(tuple(r) for r in proof_digest(manifest(df, tampered=tampered)).collect())


def test_manifest_of_awkward_rows(awkward):
    rows = [tuple(r) for r in awkward.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert digested(awkward) == slow_manifest(rows)


def test_manifest_of_trees_of_many_shapes(spark):
    sizes = {None: 1, "": 2, "a": 15, "b": 16, "B": 17, "é": 256, "e": 257, "hot": 4100, **{f"s{i}": 1 for i in range(30)}}
    rows = [(i * 7 % 5003, s, None, i, f"Text {s} {i}") for s, n in sizes.items() for i in range(n)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5))
    got = digested(df)
    assert got == slow_manifest(rows)
    assert 0 < sum(not r[-1] for r in got) < len(rows)


def test_manifest_of_one_source_one_row_and_none(spark, empty):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    for rows in ([(3, "s", "en", 1, "A")], [(3, None, None, None, None)], [(i, "s", None, None, "same") for i in range(40)], [(7, "s", None, None, "x")] * 20):
        assert digested(spark.createDataFrame(rows, schema)) == slow_manifest(rows)
    assert digested(empty) == Counter()


# ---- embeddings ----


def slow_classes(rows, cosine=0.93):
    """rows: (vec_id, vector, label)"""
    n = [0] * len(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def usable(v, label):
        return label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    for a, (_, v, label) in enumerate(rows):
        for b in range(a):
            _, w, other = rows[b]
            if usable(v, label) and usable(w, other) and label == other and len(v) == len(w):
                x, y = np.array(v, dtype=float), np.array(w, dtype=float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    n[a] += 1
                    n[b] += 1
                    root[find(a)] = find(b)
    low = {}
    for k, (i, _, _) in enumerate(rows):
        r = find(k)
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    return Counter((i, n[k], low[find(k)], i == low[find(k)]) for k, (i, _, _) in enumerate(rows))


def classes(df, **limits):
    return Counter(tuple(r) for r in embedding_classes(df, **limits).collect())


def clustered(seed, n, width, spread, size=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // size), width)) * np.geomspace(4, 0.2, width)
    picked = centres[rng.integers(0, len(centres), n)]
    return (picked + rng.normal(size=(n, width)) * spread * np.linalg.norm(picked, axis=1, keepdims=True) / np.sqrt(width)).astype(np.float32)


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("tile", [1, 7, 1024])
def test_classes_equal_brute_force(spark, tile):
    v = clustered(tile, 220, 20, 0.25)
    rows = [(i * 3 % 221, x.tolist(), (0, 0, 1, None)[i % 4]) for i, x in enumerate(v)]
    rows += [(i, (2 * v[i]).tolist(), 0) for i in range(0, 20, 4)] + [rows[4]] * 3 + [(500 + i, v[8].tolist(), 0) for i in range(40)]
    want = slow_classes(rows)
    assert sum(x[1] for x in want) > 500
    assert classes(with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(4)), tile=tile) == want


def test_query_equals_its_sql_where_vectors_link(spark, tmp_path):
    import duckdb

    from tidewatch.llm.queries import ORACLES, QUERIES

    v = clustered(4, 260, 12, 0.25)
    rows = [(i * 3 % 261, x.tolist(), (0, 0, 1, None)[i % 4]) for i, x in enumerate(v)] + [(900, v[0].tolist(), 0), (901, [0.0] * 12, 0), (902, [float("nan")] * 12, 0), (903, None, 0)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = Counter(tuple(r) for r in QUERIES["op13_embeddings"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert got == Counter(con.execute(ORACLES["op13_embeddings"]).fetchall())
    assert sum(r[1] for r in got) > 500


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, 0.25, 0.1]
    rows = [(1, v, 1), (2, v, None), (3, None, 1), (4, [0.0, 0.0, 0.0], 1), (5, [0.5, None, 0.1], 1), (6, [0.5, nan, 0.1], 1), (7, [inf, 1.0, 1.0], 1), (8, [-inf, 1.0, 1.0], 1),
            (9, [], 1), (10, [0.5, 0.25], 1), (11, [0.5, 0.25, 0.1, 0.0], 1), (None, v, 1), (None, [9.0, 0.0, 0.0], 3), (12, v, 2), (13, v, 1), (13, v, 1),
            (14, [1e-30, 5e-31, 2e-31], 1), (15, [-0.0, -0.0, -0.0], 1), (16, [1e38, 5e37, 2e37], 1), (17, [-0.5, -0.25, -0.1], 1)]
    got = classes(spark.createDataFrame(rows, SCHEMA))
    assert {r[:3] for r in got if r[0] == 13} == {(13, 5, 1)}
    assert got == Counter({(i, n, c, i == c if i is not None else c is None): k for (i, n, c, _), k in slow_classes(rows).items()})


def test_no_vector_at_all(spark):
    assert embedding_classes(spark.createDataFrame([], SCHEMA)).isEmpty()
    assert classes(spark.createDataFrame([(1, None, 1), (2, [1.0], None)], SCHEMA)) == Counter({(1, 0, 1, True): 1, (2, 0, 2, True): 1})


def test_links_at_the_limit():
    """The limit is a cosine that occurs: it counts, the next larger limit leaves it out."""
    x = clustered(5, 60, 24, 0.3).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    q, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(24, 24)))
    norms = np.linalg.norm(x, axis=1)
    i, j = np.triu_indices(60, 1)
    cosines = np.einsum("ij,ij->i", x[i], x[j]) / (norms[i] * norms[j])
    for at in np.argsort(cosines)[-200::20]:
        for limit in (cosines[at], np.nextafter(cosines[at], 2)):
            a, b = linked((x, unit @ q), None, limit)
            assert set(zip(a.tolist(), b.tolist(), strict=True)) == {(int(p), int(r)) for p, r, c in zip(i, j, cosines, strict=True) if c >= limit}


def test_far_tiles_are_not_compared(spark):
    """Of the tiles of well-parted groups, each meets few others."""
    v = clustered(9, 3000, 16, 0.02, size=200)
    rows = spark.createDataFrame([(k, "16:0", x.astype(float).tolist(), 1) for k, x in enumerate(v)], "vid long, class string, v array<double>, n long")
    from tidewatch.llm.embedding_dedup import principal_axes

    cut = tiles(rows, principal_axes(rows, 16), 20)
    n, met = cut.count(), tile_pairs(cut, 0.93).count()
    assert n >= 150
    assert met < n * (n + 1) / 2 / 4


def test_a_forest_has_the_smallest_number_of_each_class():
    assert forest(7, np.array([5, 4, 1]), np.array([4, 2, 6])).tolist() == [0, 1, 2, 3, 2, 2, 1]
    chain = np.arange(4999)
    assert not forest(5000, chain, chain + 1).any()


class Written(threading.Thread):
    """The most bytes that new files in the shared folder and in Spark's own folders had at a time."""

    def __init__(self, spark):
        super().__init__(daemon=True)
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        self.tops = [shared_dir(spark).removeprefix("file://"), *blocks]
        self.before, self.most, self.over = self.sizes(), 0, threading.Event()

    def sizes(self):
        found = {}
        for folder, name in ((d, n) for top in self.tops for d, _, names in os.walk(top) for n in names):
            with contextlib.suppress(OSError):  # a file may go meanwhile
                found[f"{folder}/{name}"] = os.path.getsize(f"{folder}/{name}")
        return found

    def run(self):
        while not self.over.wait(0.02):
            self.most = max(self.most, sum(n for f, n in self.sizes().items() if f not in self.before))

    def __enter__(self):
        self.start()
        return self

    def __exit__(self, *_):
        self.over.set()
        self.join()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_disk_does_not_grow_with_the_pairs_of_tiles(spark, monkeypatch, kind):
    """Vectors without structure: every tile of the label meets every other one."""
    from tidewatch.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "CHUNK_CELLS", 8000, raising=False)
    monkeypatch.setattr(embedding_dedup, "CHUNKS_AT_ONCE", 3, raising=False)
    n, width = 3000, 48
    noise = np.random.default_rng(9).normal(size=(1000, width)) * 0.05
    v = np.random.default_rng(8).normal(size=(n, width))
    v[2000:] = v[:1000] + noise
    v[2990:] = v[0]
    v = v.astype(np.float32).astype(float)
    rows = spark.createDataFrame([(k, x.tolist(), 0) for k, x in enumerate(v)], f"vec_id long, embedding array<{kind}>, label int").repartition(6).checkpoint()
    with Written(spark) as disk:
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_classes(rows, tile=20).collect()}
    assert disk.most < 10 * v.nbytes
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = u @ u.T >= 0.93
    assert [got[k][0] for k in range(n)] == (near.sum(axis=1) - 1).tolist()
    low = np.arange(n)
    for _ in range(20):
        low = np.where(near, low[None, :], n).min(axis=1)
    assert [got[k][1] for k in range(n)] == low.tolist()


def test_equal_vectors_of_a_batch_and_of_neighbouring_batches_become_one():
    import pyarrow as pa

    from tidewatch.llm.embedding_dedup import _distinct, _once

    def batch(rows):
        return pa.RecordBatch.from_pylist([{"vid": i, "n": n, "same": s.encode()} for i, n, s in rows], schema=pa.schema([("vid", pa.int64()), ("n", pa.int64()), ("same", pa.binary())]))

    def plain(batches):
        return [(r["vid"], r["n"], r["same"].decode()) for b in batches for r in b.to_pylist()]

    assert plain([_once(batch([(5, 1, "b"), (3, 1, "a"), (2, 2, "b"), (9, 1, "c")]))]) == [(2, 3, "b"), (3, 1, "a"), (9, 1, "c")]
    parts = [batch([(5, 1, "a"), (4, 1, "a")]), batch([]), batch([(6, 1, "a")]), batch([(1, 2, "a"), (8, 1, "b"), (7, 1, "c")]), batch([(2, 1, "c"), (3, 1, "d")])]
    assert plain(_distinct(parts)) == [(1, 5, "a"), (8, 1, "b"), (2, 2, "c"), (3, 1, "d")]
    assert plain(_distinct([batch([])])) == []
