import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm.components import components
from tidewatch.llm.quality import host_rates, judge_documents, keep_good, text_metrics
from tidewatch.llm.simhash import allocate, fingerprint, keep_one_of_each, links, masks, near_duplicates, part_values, within

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps):
    """Smallest index reachable over links of at most 3 bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(fps))]


def key(i):
    return (i is None, i or 0)


def wanted(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    of = classes(fps)
    least = {}
    for (i, _), c in zip(rows, of, strict=True):
        least[c] = min(least.get(c, (True, 0)), key(i))
    return Counter((i, f, least[c]) for (i, _), f, c in zip(rows, fps, of, strict=True))


def test_near_duplicates_equal_brute_force(awkward, rows):
    got = Counter((r.doc_id, r.fp & (1 << 64) - 1, key(r.component_id)) for r in near_duplicates(awkward).collect())
    assert got == wanted(rows)


def test_near_duplicates_of_documents(documents, table):
    got = Counter((r.doc_id, r.fp & (1 << 64) - 1, key(r.component_id)) for r in near_duplicates(documents).collect())
    assert got == wanted([(r["doc_id"], r["text"]) for r in table])


def test_one_of_each_class_stays(awkward, rows):
    left = keep_one_of_each(awkward)
    assert left.columns == awkward.columns
    of = classes([slow_fingerprint(t) for _, t in rows])
    least = {c: min(key(i) for (i, _), x in zip(rows, of, strict=True) if x == c) for c in set(of)}
    place = {(key(i), t): c for (i, t), c in zip(rows, of, strict=True)}
    assert {place[key(r.doc_id), r.text]: key(r.doc_id) for r in left.collect()} == least and left.count() == len(least)


def test_keys_may_be_texts(spark):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [("b", text), ("a", text), ("c", text + " more"), ("d", "quite another one"), (None, text)]
    df = spark.createDataFrame(rows, "name string, body string")
    got = {r.doc_id: r.component_id for r in near_duplicates(df, "name", "body").collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", None: "a"}
    assert sorted(r.name for r in keep_one_of_each(df, "name", "body").collect()) == ["a", "d"]


def test_nothing(empty):
    assert near_duplicates(empty).isEmpty()
    assert keep_one_of_each(empty).isEmpty()
    assert judge_documents(empty).isEmpty()
    assert keep_good(empty).isEmpty()


@given(st.text("ab AB\n é\x0b", max_size=60))
def test_fingerprint(text):
    assert fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("bucket", [8, 4096])
def test_links_connect_all_close_fingerprints(spark, bucket):
    r = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):  # chains of near copies around few centres, and some far ones
        x = r.getrandbits(64)
        for _ in range(25):
            fps.add(x)
            for _ in range(r.randrange(1, 5)):
                x ^= 1 << r.randrange(64)
    fps |= {r.getrandbits(64) for _ in range(100)}
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    found = components(links(spark.createDataFrame(signed, "fp long").repartition(4).checkpoint(), bucket=bucket))
    label = {x.vertex & (1 << 64) - 1: x.root for x in found.collect()}
    of = classes(fps)
    for i, j in itertools.combinations(range(len(fps)), 2):
        same = label.get(fps[i], ("alone", i)) == label.get(fps[j], ("alone", j))
        assert same == (of[i] == of[j])


def test_allocation_is_cheapest_and_complete():
    r = np.random.default_rng(3)
    widths = [6, 6, 6, 6]
    counts = [r.integers(0, 50, 1 << w) * r.integers(0, 2, 1 << w) for w in widths]
    near = [within(c, w, 3) for c, w in zip(counts, widths, strict=True)]
    values = [r.integers(0, 1 << w, 30) for w in widths]
    got = allocate(values, near, widths, 3)
    assert (got.sum(axis=1) == 3 - 4 + 1).all() and got.min() >= -1

    def cost(k, limits):
        return sum(near[i][t][values[i][k]] + 2 * sum(len(masks(widths[i], x)) for x in range(t + 1)) for i, t in enumerate(limits) if t >= 0)

    options = [o for o in itertools.product(range(-1, 4), repeat=4) if sum(o) == 0]
    for k in range(30):
        assert cost(k, got[k]) == min(cost(k, o) for o in options)


def test_counts_within_a_distance():
    counts = np.random.default_rng(1).integers(0, 9, 32)
    for radius, found in enumerate(within(counts, 5, 2)):
        assert found.tolist() == [sum(counts[v] for v in range(32) if (u ^ v).bit_count() <= radius) for u in range(32)]
    assert part_values(np.array([0b1011], dtype=np.uint64), [0, 2, 3]).tolist() == [0b101]


@settings(deadline=None, max_examples=5)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=30))
def test_components(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    root = {v: v for p in pairs for v in p}
    for _ in range(40):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    linked = {v for a, b in pairs if a != b for v in (a, b)}
    assert {(r.vertex, r.root) for r in components(df).collect()} == {(v, root[v]) for v in linked}


def slow_metrics(text):
    words = WORD.findall(text)
    runs = {}
    for i in range(len(words) - 4):
        runs.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p for at in runs.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    lines = text.split("\n")
    again = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


@given(st.text("ab \n\x0b#|é", max_size=80))
def test_metrics(text):
    assert text_metrics(text) == slow_metrics(text)


def test_judged_documents(awkward, rows):
    want = Counter()
    for i, t in rows:
        m = slow_metrics(t or "") if len(t or "") < 60_000 else text_metrics(t)
        failed = m[0] < 10 or 100 * m[4] > 20 * m[0]
        want[(i, *m, failed)] += 1
    got = judge_documents(awkward).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert all(not (r.base_failed and r.kept) for r in got)
    assert keep_good(awkward).columns == awkward.columns
    assert keep_good(awkward).count() == sum(r.kept for r in got)


def slow_condemned(judged):
    """Hosts above the limit, from (host, failed) of every document: a beta prior by the moments of all hosts' rates."""
    n, f = Counter(), Counter()
    for host, failed in judged:
        if host is not None:
            n[host] += 1
            f[host] += failed
    if not n:
        return set()
    total = sum(n.values())
    mean = (sum(f.values()) + 0.5) / (total + 1)
    spread = sum(f[h] ** 2 / n[h] for h in n) / total - (sum(f.values()) / total) ** 2
    within_hosts = mean * (1 - mean) * len(n) / total
    weight = 1e6
    if spread > within_hosts:
        weight = min(1e6, max(1.0, mean * (1 - mean) / (spread - within_hosts) - 1))
    out = set()
    for h in n:
        a, size = f[h] + mean * weight, n[h] + weight
        rate = a / size
        if rate - 2 * (rate * (1 - rate) / (size + 1)) ** 0.5 > 0.5:
            out.add(h)
    return out


def test_condemned_hosts_equal_brute_force(spark):
    r = random.Random(11)
    good = " ".join(f"word{i}" for i in range(40))
    rows = []
    for h in range(40):
        share = r.choice([0, 0.1, 0.5, 0.9, 1])
        rows += [(len(rows) + k, "short" if r.random() < share else good, f"host{h}") for k in range(r.randrange(1, 60))]
    judged = judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    bad = slow_condemned([(h, t == "short") for _, t, h in rows])
    assert 3 < len(bad) < 37
    assert {x.doc_id for x in judged if x.kept} == {i for i, t, h in rows if t == good and h not in bad}


def test_bad_hosts_lose_their_good_documents(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, "short", f"bad{i % 3}") for i in range(300)] + [(300 + i, good + str(i), f"bad{i % 3}") for i in range(9)]
    rows += [(1000 + i, good + str(i), f"good{i % 30}") for i in range(900)] + [(2000 + i, "short", f"good{i}") for i in range(30)]
    rows += [(3000, "short", "new"), (3001, good, "new"), (3002, "short", "new2"), (3003, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in judge_documents(df).collect() if r.kept}
    assert not kept & set(range(309))
    assert kept == set(range(1000, 1900)) | {3001, 3003}
    rates = {r.host: r for r in host_rates(judge_documents(df).join(df.select("doc_id", "source"), "doc_id"), "source").collect()}
    assert rates["bad0"].rate > 0.8 and 0 < rates["new2"].rate < 1 and rates["good0"].rate < 0.2
