import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewatch.llm import tokens
from tidewatch.llm.bpe import PrefixEncoder, decode_documents, encode_documents, round_trip
from tidewatch.llm.packing import combinations, pack_documents, packing_plan
from tidewatch.llm import token_files
from tidewatch.llm.token_files import EliasFano, look_up, read_token_files, token_file_digests, write_token_files
from tidewatch.llm.tokens import MARKS, PieceTokenizer, single_spaced, strides

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def library(path, texts):
    t = Tokenizer.from_file(path)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def odd_texts():
    r = random.Random(1)
    out = ["", " ", "  a", "a   b", "a \n \n b", "x\n y", "a <|endoftext|> b", "a \n <|endoftext|> c", "<|startoftext|>x", "end ", "a\n ", "é́ ́x", "İ Σς", "aaaaaaaaaaaaaaaaaaaa"]
    for letters in ("ab \n\t ' é1.<", "abcdehinorstu", "'sreltvdm "):
        out += ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(400)]
    return out + ["".join(chr(r.randrange(1, 0x3100)) for _ in range(r.randrange(20))) for _ in range(600)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_ids_of_whole_texts(path, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 300)
    texts = odd_texts()
    coder = PieceTokenizer(path)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == library(path, texts)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_other_case_does_not_make_special_strings(path):
    texts = ["end <|EndOfText|> here", "<|STARTOFTEXT|>", "A <|endofTEXT|>\nb <|endoftext|> C", "Été <|StartOfText|>, OK", "Ω <|EndOfText|>", "x<|ENDOFTEXT|>Y. End"]
    assert [np.frombuffer(x, "<u4").tolist() for x in PieceTokenizer(path).encode(texts)] == library(path, texts)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_every_letter_before_every_mark(path):
    """Some letters end, normalized, in a sign that the mark joins."""
    letters = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}{m}" for c in letters[at : at + 500]) for m in MARKS for at in range(0, len(letters), 500)]
    assert [np.frombuffer(x, "<u4").tolist() for x in PieceTokenizer(path).encode(texts)] == library(path, texts)


@given(st.text("a \n\t\x1c\xa0\u2028", max_size=9))
def test_single_spaces(text):
    words = text.split()
    blanks = text.count(" ") + text.count("\n")
    assert single_spaced(text) == (len(words) == blanks + 1 and len(text) - sum(map(len, words)) == blanks)


@given(st.text("ab \n", max_size=80), st.integers(1, 9))
def test_strides_put_together_give_the_text(text, size):
    parts = list(strides(text, size))
    assert "".join(parts) == text and all(p.startswith(" ") for p in parts[1:])


def test_prefix_encoder_is_exact():
    texts = odd_texts()
    coder = PrefixEncoder(BYTES)
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]
    assert got == library(BYTES, texts)
    t = Tokenizer.from_file(BYTES)
    assert [coder.decode(x) for x in got] == [t.decode(x, skip_special_tokens=False) for x in got]


def test_round_trip_of_documents(awkward, rows):
    texts = [t or "" for _, t in rows]
    want = Counter()
    for (i, _), ids, text in zip(rows, library(BYTES, texts), texts, strict=True):
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, round_trip(awkward, BYTES).collect())) == want
    encoded = encode_documents(awkward, BYTES)
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == Counter((i, tuple(x)) for (i, _), x in zip(rows, library(BYTES, texts), strict=True))
    assert Counter(map(tuple, decode_documents(encoded, BYTES).collect())) == Counter((i, t or "") for i, t in rows)


@settings(deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=200))
def test_elias_fano_selects_every_number(values):
    values = np.sort(np.array(values, dtype=np.int64))
    code = EliasFano.of(values)
    assert code.select_many(np.arange(len(values))).tolist() == values.tolist() == [code.select(k) for k in range(len(values))]
    some = np.random.default_rng(len(values)).permutation(len(values))[:20]
    assert code.select_many(some).tolist() == values[some].tolist()
    assert 8 * (len(code.low) + len(code.high)) <= len(values) * (3 + max(1, int(values.max(initial=1)) // max(1, len(values))).bit_length()) + 24
    for k in (-1, len(values)):
        with pytest.raises(IndexError):
            code.select(k)
        with pytest.raises(IndexError):
            code.select_many(np.array([k]))


def test_elias_fano_with_a_long_gap():
    values = np.concatenate([np.arange(5000), 10**9 + np.arange(3)])
    code = EliasFano.of(values)
    assert code.select_many(np.arange(len(values))).tolist() == values.tolist()


@pytest.mark.parametrize("ids, docs, group", [(1 << 20, 1 << 14, 1 << 24), (3000, 4, 500), (50, 1, 1)])
def test_token_files_hold_every_document(spark, awkward, rows, tmp_path, monkeypatch, ids, docs, group):
    for name, value in (("BLOCK_IDS", ids), ("BLOCK_DOCS", docs), ("GROUP_IDS", group)):
        monkeypatch.setattr(token_files, name, value)
    path = str(tmp_path / "files")
    write_token_files(awkward, path, BYTES)
    assert all(r.n_docs == 1 or (r.n_ids <= ids and r.n_docs <= docs) for r in spark.read.parquet(path).collect())
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    digests = {(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got}
    assert {tuple(r) for r in token_file_digests(spark, path).collect()} == digests
    few = awkward.filter("doc_id IN (6, 12, 15) OR doc_id IS NULL").select("doc_id").unionByName(spark.range(90, 95).toDF("doc_id"))
    assert Counter(map(tuple, look_up(spark, path, few).collect())) == Counter(map(tuple, (r for r in got if r.doc_id in (6, 12, 15))))
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    want = Counter((i, tuple([*ids, 0])) for (i, _), ids in zip(rows, library(BYTES, [t for _, t in rows]), strict=True))
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want


def test_keys_may_be_texts(spark, tmp_path):
    docs = spark.createDataFrame([("b", "two words"), ("a", "one")], "name string, body string")
    path = str(tmp_path / "files")
    write_token_files(docs, path, BYTES, id_col="name", text_col="body")
    assert [(r.doc_id, r.n_tokens) for r in read_token_files(spark, path).orderBy("start").collect()] == [("a", 2), ("b", 3)]
    assert {r.doc_id for r in pack_documents(docs, WORDS, id_col="name", text_col="body").collect()} == {"a", "b"}


def test_wide_ids_and_many_equal_keys(spark, tmp_path):
    docs = spark.createDataFrame([(7, f"word {i}") for i in range(3000)] + [(i, "x") for i in range(40)], "doc_id long, text string").repartition(6)
    path = str(tmp_path / "files")
    write_token_files(docs, path, BYTES, end_id=1 << 17)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([7] * 3000 + list(range(40)))
    assert {np.frombuffer(r.ids, "<u4")[-1] for r in got} == {1 << 17}
    # One key's documents lie in several parts.
    assert spark.read.parquet(path).selectExpr("part", "explode(doc_ids) AS d").filter("d = 7").select("part").distinct().count() > 1


def test_token_files_of_nothing(spark, empty, tmp_path):
    path = str(tmp_path / "files")
    write_token_files(empty, path, BYTES)
    assert read_token_files(spark, path).isEmpty()


@given(st.dictionaries(st.integers(1, 60), st.integers(0, 40), max_size=40))
def test_combinations_use_every_piece_once(counts):
    used, sequences = Counter(), 0
    for lengths, times in combinations(counts, 60):
        assert times > 0 and sum(lengths) <= 60
        sequences += times
        for x in lengths:
            used[x] += times
    assert used == +Counter(counts)
    total = sum(k * n for k, n in counts.items())
    assert sequences <= 2 * -(-total // 60) + 1


def test_exact_complements_leave_no_gap():
    counts = Counter({50: 3, 10: 1, 6: 2, 4: 2, 5: 1, 3: 1, 2: 1})
    assert sorted(sum(c) for c, n in combinations(counts, 60) for _ in range(n)) == [10, 60, 60, 60]


def test_packing_close_to_the_bound():
    lengths = np.random.default_rng(0).integers(1, 2049, 50_000)
    n = sum(k for _, k in combinations(Counter(lengths.tolist()), 2048))
    assert n <= 1.01 * max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()))


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 20), min_size=1, max_size=20))
def test_plan_places_pieces_without_overlap(counts):
    plan = packing_plan(counts, 30)
    length = np.repeat(list(counts), list(counts.values()))
    number = np.concatenate([np.arange(n) for n in counts.values()])
    sequence, offset = plan.place(length, number)
    taken = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True):
        taken[s].append((o, n))
    for places in taken.values():
        end = 0
        for o, n in sorted(places):
            assert o == end
            end += n
        assert end <= 30
    assert sorted(taken) == list(range(len(taken)))


@pytest.mark.parametrize("keep_ids", [True, False])
def test_packed_documents(awkward, rows, keep_ids):
    got = pack_documents(awkward, WORDS, 256, keep_ids=keep_ids).collect()
    want = Counter()
    for (i, _), ids in zip(rows, library(WORDS, [t for _, t in rows]), strict=True):
        ids = [*ids, 0]
        for piece, start in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[start : start + 256], dtype="<u4").tobytes()
            want[i, piece, start, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert all((r.ids is not None and zlib.crc32(r.ids) == r.ids_crc32) if keep_ids else r.ids is None for r in got)
    taken = defaultdict(list)
    for r in got:
        taken[r.sequence_id].append((r.offset, r.length))
    for places in taken.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1].tolist()] and sum(n for _, n in places) <= 256


def test_nothing_to_pack(empty):
    assert pack_documents(empty, WORDS).isEmpty()
    assert round_trip(empty, BYTES).isEmpty()
