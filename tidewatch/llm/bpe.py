"""Byte-level BPE by dynamic programming over prefixes.

A text has one BPE encoding, and so has each of its prefixes; the last token of a prefix's encoding is the one vocabulary entry that ends the
prefix and is compatible with the last token of the prefix before it. Two tokens are compatible if BPE leaves them side
by side, which shows when both are taken apart merge by merge along their common border. A suffix automaton of
the vocabulary, run over the text, gives the entries that end at each byte, longest first. The last tokens are stored for every
prefix, and following them back from the end gives the ids, in time proportional to the text.

The text is first cut into words as byte-level vocabularies do. Words repeat, so each worker remembers a bounded number of them.

Defined cases: a null or empty text has no ids and decodes to the empty text; a string of an added token in the text becomes that
token; repeated rows give repeated results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.common import with_text
from tidewatch.llm.tokens import PieceMemory, byte_letters

# Fixed value: how this family of vocabularies cuts a text into words. White space is spelled out.
_SPACE = "\t-\r \x85\xa0  -     　"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"

#: Rank of what no merge makes or uses.
_NEVER = 1 << 30
#: Pairs and words remembered in a worker.
REMEMBERED_PAIRS = 400_000
REMEMBERED_WORDS = 200_000
LONGEST_WORD = 40
#: Documents taken at once.
DOCS = 1000


@dataclass
class Vocabulary:
    """Token bytes by id, and how merges make them."""

    text: list[bytes]
    left: list[int]
    right: list[int]
    rank: list[int]  # of the merge that makes the token; -1 for a single byte
    pair: dict[int, int]  # left << 20 | right: rank of their merge
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        vocab = spec["model"]["vocab"]
        size = max([*vocab.values(), *special.values()]) + 1
        out = cls([b""] * size, [-1] * size, [-1] * size, [-1] * size, {}, special)
        for token, i in vocab.items():
            if token not in special:
                out.text[i] = bytes(letters[c] for c in token)
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            made, x, y = vocab[a + b], vocab[a], vocab[b]
            out.pair[x << 20 | y] = rank
            if out.rank[made] < 0:
                out.left[made], out.right[made], out.rank[made] = x, y, rank
        for content, i in special.items():
            out.text[i] = content.encode()
        return out

    def beside(self, a: int, b: int, made: bool = False) -> bool:
        """Whether BPE leaves a and b side by side. ``made``: up to the moment when a and b themselves merge.

        Going back in time, the token that was made last is taken apart; what touches the border at any time must not merge
        before one of the two is used up. Of equal merges the left one comes first.
        """
        rank, pair = self.rank, self.pair
        until_a = until_b = _NEVER
        first = made
        while True:
            m = -1 if first else pair.get(a << 20 | b, -1)
            first = False
            if m >= 0 and m < until_a and m <= until_b:
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                until_a, a = rank[a], self.right[a]
            else:
                until_b, b = rank[b], self.left[b]


@dataclass
class SuffixAutomaton:
    """The substrings of all tokens. ``top``: the longest token that ends the longest string of a state, -1 if none does."""

    step_from: np.ndarray  # state << 8 | byte
    step_to: np.ndarray
    link: np.ndarray
    length: np.ndarray
    top: np.ndarray
    shorter: np.ndarray  # for a token: the longest other token that ends it

    @classmethod
    def of(cls, tokens: Sequence[tuple[int, bytes]], ids: int) -> SuffixAutomaton:
        steps: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def split(p: int, c: int, q: int) -> int:
            """A state of its own for the strings of q that are reached through p."""
            steps.append(steps[q].copy())
            link.append(link[q])
            length.append(length[p] + 1)
            link[q] = clone = len(steps) - 1
            while p >= 0 and steps[p].get(c) == q:
                steps[p][c] = clone
                p = link[p]
            return clone

        def extend(last: int, c: int) -> int:
            q = steps[last].get(c)
            if q is not None:  # the string is there from an earlier token
                return q if length[q] == length[last] + 1 else split(last, c, q)
            steps.append({})
            link.append(0)
            length.append(length[last] + 1)
            new = len(steps) - 1
            p = last
            while p >= 0 and c not in steps[p]:
                steps[p][c] = new
                p = link[p]
            if p >= 0:
                q = steps[p][c]
                link[new] = q if length[q] == length[p] + 1 else split(p, c, q)
            return new

        for _, text in tokens:
            state = 0
            for c in text:
                state = extend(state, c)
        own: list[list[int]] = [[] for _ in steps]
        size = {}
        for i, text in tokens:
            state = 0
            for c in text:
                state = steps[state][c]
            own[state].append(i)
            size[i] = len(text)
        top, shorter = np.full(len(steps), -1, dtype=np.int32), np.full(ids, -1, dtype=np.int32)
        for state in sorted(range(1, len(steps)), key=length.__getitem__):
            longest = top[link[state]]
            for i in sorted(own[state], key=size.__getitem__):
                shorter[i], longest = longest, i
            top[state] = longest
        moves = [(s << 8 | c, t) for s, x in enumerate(steps) for c, t in x.items()]
        table = np.array(moves, dtype=np.int32)
        return cls(table[:, 0].copy(), table[:, 1].copy(), np.array(link, dtype=np.int32), np.array(length, dtype=np.int32), top, shorter)


class PrefixEncoder(PieceMemory):
    """Exact BPE ids of texts, and texts of ids."""

    def __init__(self, path: str, automaton: SuffixAutomaton | None = None) -> None:
        import regex

        self.vocab = v = Vocabulary.load(path)
        super().__init__(spaced=True, worded=False, special=list(v.special))
        self.words = regex.compile(WORDS)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(v.special, key=len, reverse=True)))) if v.special else None
        automaton = automaton or automaton_of(path)
        self.steps = dict(zip(automaton.step_from.tolist(), automaton.step_to.tolist(), strict=True))
        self.link, self.length = automaton.link.tolist(), automaton.length.tolist()
        self.top, self.shorter = automaton.top.tolist(), automaton.shorter.tolist()
        self.size = [len(t) for t in v.text]
        self.pairs: dict[int, bool] = {}
        self.special_ids = {s: array("I", [i]).tobytes() for s, i in v.special.items()}
        self.word_ids = dict(self.special_ids)
        self.decimal = [str(i).encode() for i in range(len(v.text))]

    def learn(self, words: Iterable[str]) -> None:
        """Encodes words not met before. In sorted order, a word goes on from the prefix it shares with the one before."""
        known, size, step, link, length, top, shorter = self.word_ids, self.size, self.steps.get, self.link, self.length, self.top, self.shorter
        pairs, beside = self.pairs, self.vocab.beside
        if len(pairs) > REMEMBERED_PAIRS:
            pairs.clear()
        last, states, lengths = [-1], [0], [0]  # for each prefix: last token, automaton state, matched length
        previous = b""
        for word, data in sorted(((w, w.encode("utf-8", "surrogatepass")) for w in set(words) if w not in known), key=lambda x: x[1]):
            shared, most = 0, min(len(previous), len(data))
            while shared < most and previous[shared] == data[shared]:
                shared += 1
            del last[shared + 1 :], states[shared + 1 :], lengths[shared + 1 :]
            previous = data
            state, matched = states[shared], lengths[shared]
            for end in range(shared + 1, len(data) + 1):
                c = data[end - 1]
                after = step(state << 8 | c)
                while after is None:
                    state = link[state]
                    matched = length[state]
                    after = step(state << 8 | c)
                state = after
                matched += 1
                token = top[state]
                while size[token] > matched:
                    token = shorter[token]
                while True:
                    before = last[end - size[token]]
                    if before < 0:  # the token is the whole prefix
                        break
                    key = before << 20 | token
                    good = pairs.get(key)
                    if good is None:
                        good = pairs[key] = beside(before, token)
                    if good:
                        break
                    token = shorter[token]
                last.append(token)
                states.append(state)
                lengths.append(matched)
            found = array("I")
            end = len(data)
            while end:
                found.append(last[end])
                end -= size[last[end]]
            found.reverse()
            known[word] = found.tobytes()

    def whole(self, texts: Sequence[str]) -> list[bytes]:
        split = [self._words(t) for t in texts]
        self.learn(w for words in split for w in words if w not in self.special)
        get = self.word_ids.__getitem__
        out = [b"".join(map(get, words)) for words in split]
        if len(self.word_ids) > REMEMBERED_WORDS:
            self.word_ids = dict(self.special_ids)
        else:
            for w in [w for words in split for w in words if len(w) > LONGEST_WORD and w not in self.special]:
                self.word_ids.pop(w, None)
        return out

    def _words(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return self.words.findall(text)
        out: list[str] = []
        at = 0
        for found in self.specials.finditer(text):
            out += self.words.findall(text[at : found.start()])
            out.append(found[0])
            at = found.end()
        return out + self.words.findall(text[at:])

    def decode(self, ids: Sequence[int]) -> str:
        return b"".join(map(self.vocab.text.__getitem__, ids)).decode("utf-8", "replace")


def automaton_of(path: str) -> SuffixAutomaton:
    v = Vocabulary.load(path)
    # A token that BPE would not make of its own bytes never comes out, so it is left out.
    usable = [(i, t) for i, t in enumerate(v.text) if t and i not in v.special.values() and (v.rank[i] < 0 or v.beside(v.left[i], v.right[i], made=True))]
    return SuffixAutomaton.of(usable, len(v.text))


_ENCODERS: dict[str, PrefixEncoder] = {}


def _encoder(path: str, automaton: Broadcast) -> PrefixEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PrefixEncoder(path, automaton.value)
    return _ENCODERS[path]


def _shared(spark: SparkSession, path: str) -> Broadcast:
    """The automaton, built once; its size is that of the vocabulary."""
    return spark.sparkContext.broadcast(automaton_of(path))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids of every whole text."""
    automaton = _shared(docs.sparkSession, path)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, automaton)
        for batch in batches:
            for begin in range(0, batch.num_rows, DOCS):
                few = batch.slice(begin, DOCS)
                ids = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in encoder.encode(few.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([few.column("doc_id"), pa.array(ids, type=pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return with_text(docs, id_col, text_col).mapInArrow(encode, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from ``doc_id`` and ids; null ids are none."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = Vocabulary.load(path).text
        for batch in batches:
            found = [b"".join(map(text.__getitem__, ids or ())).decode("utf-8", "replace") for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, type=pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", ids_col).mapInArrow(decode, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes and decodes in one task, for those who need no ids in Spark."""
    automaton = _shared(docs.sparkSession, path)

    def both(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, automaton)
        for batch in batches:
            for begin in range(0, batch.num_rows, DOCS):
                few = batch.slice(begin, DOCS)
                n, ids_sha, text_sha = [], [], []
                for raw in encoder.encode(few.column("text").to_pylist()):
                    ids = np.frombuffer(raw, dtype="<u4").tolist()
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(b",".join(map(encoder.decimal.__getitem__, ids))).hexdigest())
                    text_sha.append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [few.column("doc_id"), pa.array(n, type=pa.int64()), pa.array(ids_sha, type=pa.string()), pa.array(text_sha, type=pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return with_text(docs, id_col, text_col).mapInArrow(both, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
