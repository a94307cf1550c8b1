import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from tests.llm.test_near_and_quality import slow_condemned, slow_fingerprint, slow_metrics, wanted
from tests.llm.test_spans import slow_secrets
from tests.llm.test_tokens import WORDS, library
from tidewatch.llm import langid, tokens
from tidewatch.llm.langid import ByteNetwork, Reader, as_rows, fit, identify_languages, predict


def test_gradients_agree_with_differences():
    net = ByteNetwork.fresh(["a", "b", "c"], 4, np.random.default_rng(0))
    net = ByteNetwork(net.languages, *[w.astype(np.float64) for w in net.weights()])
    rows, lengths = as_rows([b"abc", b"xy", b"hello", b"q"])
    labels = np.array([0, 1, 2, 1])
    _, grads = net.gradients(rows, lengths, labels)
    for w, g in zip(net.weights(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, eps = w[at], 1e-3
        w[at] = old + eps
        up, _ = net.gradients(rows, lengths, labels)
        w[at] = old - eps
        down, _ = net.gradients(rows, lengths, labels)
        w[at] = old
        assert abs((up - down) / (2 * eps) - g[at]) < 1e-4 * max(1, abs(g[at]))


def test_reader_adds_up_all_positions(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    net = ByteNetwork.fresh(["x", "y"], 4, np.random.default_rng(1))
    reader = Reader(net)
    texts = ["One two, one", "", " drei\nvier " + "lang" * 30, "12 !!", "(one)", "  a  ", "x"]
    for _ in range(2):
        got = reader.read(texts)
        for text, total in zip(texts, got, strict=True):
            data = text.encode().lower()
            p = reader.positions(text)
            assert p.shape == (len(data), 2)
            keep = [chr(b).isalpha() for b in data]
            want = [*p[keep].sum(axis=0), sum(keep)]
            assert np.allclose(total, want, atol=1e-4)


def test_every_byte_is_read_in_order():
    net = ByteNetwork.fresh(["x", "y"], 4, np.random.default_rng(1))
    text = "Ein, zwei;\n(drei) " + "vier" * 20 + " é"
    p = Reader(net).positions(text)
    assert p.shape == (len(text.encode()), 2) and np.allclose(p.sum(axis=1), 1)
    at = 0
    for piece in text.split(" "):
        data = langid.unit(piece)
        for a in range(0, len(data), langid.SLICE):
            part = data[a : a + langid.SLICE]
            want = net.forward(*as_rows([part]))["p"][:, 0]
            assert np.allclose(p[at : at + len(part)], want[: len(p) - at], atol=1e-6)
            at += len(part)
    assert at == len(p) + 1


def test_training_reads_whole_texts(spark):
    texts = {1: ("the " * 3000 + "end, of.  it", "en"), 2: ("der die das", "de"), 3: (None, "de"), 4: ("no label", None)}
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in texts.items()], "doc_id long, text string, lang string")
    got = langid.training_slices(docs, "text", "lang", langid.F.lit(0).cast("long"))
    want = Counter((lang, s) for t, lang in texts.values() if t and lang for s in langid.sliced(map(langid.unit, t.split(" "))))
    assert {(lang, s): n for lang, s, n in got} == want
    assert want["en", b"the "] == 3000 and want["en", b" "] == 1


def test_held_out_documents_are_recognised(spark, documents):
    truth = {r["doc_id"]: r["lang"] for r in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "lang"]).to_pylist()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_languages(docs, docs_per_language=200).collect()
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_awkward_rows(awkward, rows, empty):
    net = fit([("en", b"the ", 5), ("de", b"der ", 5)], steps=3)
    got = predict(awkward, net).collect()
    want = Counter(i for i, _ in rows)
    assert Counter(r.doc_id for r in got) == want
    unread = Counter(i for i, t in rows if not t or not re.search(r"[^\W\d_]", t))
    assert Counter(r.doc_id for r in got if r.lang_pred == "und") == unread
    assert identify_languages(empty).isEmpty()
    nobody = identify_languages(awkward.withColumn("lang", awkward.nothing)).collect()
    assert {(r.lang_pred, r.score) for r in nobody} == {("und", 0.0)}


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The documents before the pipeline and behind each of its stages."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def test_every_stage_against_brute_force(staged):
    raw, good, single, apart, clean, packed = map(as_dicts, staged)
    by_id = {r["doc_id"]: r for r in raw}

    def fails(text):
        m = slow_metrics(text or "")
        return m[0] < 10 or 100 * m[4] > 20 * m[0]

    condemned = slow_condemned([(r["source"], fails(r["text"])) for r in raw])
    assert {r["doc_id"] for r in good} == {i for i, r in by_id.items() if not fails(r["text"]) and r["source"] not in condemned}
    last = {}
    for r in good:
        last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
    assert Counter(r["doc_id"] for r in single) == Counter(last.values())
    stay = {c[1] for _, _, c in wanted([(r["doc_id"], r["text"]) for r in single])}
    assert Counter(r["doc_id"] for r in apart) == Counter(stay)
    assert len({slow_fingerprint(r["text"]) for r in apart}) == len(apart)
    for df in (good, single, apart):
        assert all(r == by_id[r["doc_id"]] for r in df)
    want = []
    for i in stay:
        row = by_id[i]
        text, at, out = row["text"], 0, ""
        spans = slow_secrets(text)[1]
        for k, (start, _, _, end) in enumerate(spans):
            if start > at or k == 0:
                out += text[at:start] + "[secret]"
            at = max(at, end)
        clear = out + text[at:]
        want.append({**row, "text": clear, "n_chars": len(clear) if spans else row["n_chars"]})
    assert sorted(clean, key=lambda r: r["doc_id"]) == sorted(want, key=lambda r: r["doc_id"])
    assert any("[secret]" in r["text"] for r in clean)
    for df, source in zip(staged[1:-1], staged[:-2], strict=True):
        assert df.columns == source.columns
    pieces = Counter()
    for r, ids in zip(clean, library(WORDS, [r["text"] for r in clean]), strict=True):
        ids = [*ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], dtype="<u4").tobytes()
            pieces[r["doc_id"], piece, start, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == pieces
    taken = defaultdict(list)
    for r in packed:
        taken[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in taken.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1].tolist()] and sum(n for _, n in places) <= 2048
    assert len(taken) <= 1.02 * sum(r["length"] for r in packed) / 2048 + 1


def test_pipeline_of_awkward_and_no_rows(spark, awkward, empty):
    for docs in (awkward, empty):
        for _, stage in corpus_pipeline.STAGES:
            columns, docs = docs.columns, stage(spark, docs, "").checkpoint()
            assert docs.columns == columns or "sequence_id" in docs.columns
    assert docs.isEmpty()
