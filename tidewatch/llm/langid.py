"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads the bytes of a text forwards and backwards and gives every position a probability for each language; a document's
probabilities are the mean over the positions of letters in its whole text. It is trained here in numpy, by backpropagation through time.

A text is taken as units: what stands before a space, with that space, ASCII letters small, in slices of at most ``SLICE`` bytes. Units
hold every byte of a text once (and a space behind its end). The state starts anew at each, so units can run as one matrix, and what a unit
adds is the same wherever it stands: workers remember it for a bounded number of units.

Training reads the whole texts of about ``docs_per_language`` labelled documents of each language, chosen by hash; units are drawn as often as they
stand there. That bound is the method's own parameter; everything else covers all rows and whole texts.

Defined cases: a null text, one without a letter, and any text when nothing was learned give ``und`` and score 0; a null label is not
learned from; a null key is not held out; a very long text is read whole; repeated rows give repeated results; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored
from tidewatch.llm.tokens import WordTable

UNKNOWN = "und"
HIDDEN = 16
SLICE = 32
DOCS_PER_LANGUAGE = 600
STEPS = 500
BATCH = 512
RATE = 0.01
SEED = 7
#: Bytes that count as letters: ASCII letters, and all bytes of other characters.
LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])


def unit(piece: str) -> bytes:
    """The bytes that the network reads of a piece that a space ends, or the text's end."""
    return piece.encode("utf-8", "surrogatepass").lower() + b" "


def sliced(units: Iterable[bytes]) -> Iterator[bytes]:
    for u in units:
        for a in range(0, len(u), SLICE):
            yield u[a : a + SLICE]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class ByteNetwork:
    """Two recurrent layers (forwards, backwards) of ``hidden`` units and a softmax over languages.

    Gates stand in the order update, reset, candidate. Axis 0 of every recurrent array is the direction.
    """

    languages: list[str]
    inputs: np.ndarray  # 2 x 256 x 3h: what a byte adds to the gates
    back: np.ndarray  # 2 x h x 3h
    bias: np.ndarray  # 2 x 1 x 3h
    out: np.ndarray  # 2h x languages
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: Sequence[str], hidden: int, rng: np.random.Generator) -> ByteNetwork:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        h, n = hidden, len(languages)
        return cls(
            list(languages),
            normal(2, 256, 3 * h, scale=0.3),
            normal(2, h, 3 * h, scale=h**-0.5),
            np.zeros((2, 1, 3 * h), np.float32),
            normal(2 * h, n, scale=(2 * h) ** -0.5),
            np.zeros(n, np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.back, self.bias, self.out, self.out_bias]

    def forward(self, words: np.ndarray, lengths: np.ndarray) -> dict:
        """Runs over rows of bytes; ``states[d, t]`` is direction d's state once it has read position t."""
        n, steps = words.shape
        h = self.back.shape[1]
        there = (np.arange(steps)[None, :] < lengths[:, None]).astype(np.float32)
        states = np.zeros((2, steps, n, h), np.float32)
        tape = []
        state = np.zeros((2, n, h), np.float32)
        for step in range(steps):
            t = (step, steps - 1 - step)
            x = np.stack([self.inputs[d][words[:, t[d]]] for d in (0, 1)]) + self.bias
            u = state @ self.back
            zr = _sigmoid(x[..., : 2 * h] + u[..., : 2 * h])
            z, r = zr[..., :h], zr[..., h:]
            c = np.tanh(x[..., 2 * h :] + r * u[..., 2 * h :])
            m = np.stack([there[:, t[0]], there[:, t[1]]])[..., None]
            after = state + m * (1 - z) * (c - state)
            tape.append((state, z, r, c, u[..., 2 * h :], m))
            state = after
            states[0, t[0]], states[1, t[1]] = state[0], state[1]
        joined = np.concatenate([states[0], states[1]], axis=-1)  # steps x n x 2h
        scores = joined @ self.out + self.out_bias
        scores -= scores.max(axis=-1, keepdims=True)
        p = np.exp(scores)
        p /= p.sum(axis=-1, keepdims=True)
        return {"p": p, "joined": joined, "tape": tape, "there": there}

    def gradients(self, words: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions, and its gradient for every weight, through time in both directions."""
        run = self.forward(words, lengths)
        n, steps = words.shape
        h = self.back.shape[1]
        there = run["there"].T[..., None]  # steps x n x 1
        count = there.sum()
        right = np.zeros_like(run["p"])
        right[:, np.arange(n), labels] = 1
        loss = float(-(np.log((run["p"] * right).sum(axis=-1) + 1e-9) * there[..., 0]).sum() / count)
        d_scores = (run["p"] - right) * there / count
        d_out = np.einsum("tnh,tnl->hl", run["joined"], d_scores)
        d_joined = d_scores @ self.out.T
        d_inputs, d_back, d_bias = np.zeros_like(self.inputs), np.zeros_like(self.back), np.zeros_like(self.bias)
        d_state = np.zeros((2, n, h), np.float32)
        for step in range(steps - 1, -1, -1):
            t = (step, steps - 1 - step)
            before, z, r, c, u_c, m = run["tape"][step]
            d_state = d_state + np.stack([d_joined[t[0], :, :h], d_joined[t[1], :, h:]])
            d_c = d_state * m * (1 - z) * (1 - c * c)
            d_z = d_state * m * (before - c) * z * (1 - z)
            d_r = d_c * u_c * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_c * r], axis=-1)
            d_x = np.concatenate([d_z, d_r, d_c], axis=-1)
            d_back += before.transpose(0, 2, 1) @ d_u
            d_bias += d_x.sum(axis=1, keepdims=True)
            for d in (0, 1):
                np.add.at(d_inputs[d], words[:, t[d]], d_x[d])
            d_state = d_state * (1 - m * (1 - z)) + d_u @ self.back.transpose(0, 2, 1)
        return loss, [d_inputs, d_back, d_bias, d_out, d_scores.sum(axis=(0, 1))]


def as_rows(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words as zero-filled rows of bytes, and their lengths."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    width = int(lengths.max(initial=1))
    rows = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8)
    return rows.reshape(len(words), width), lengths


def fit(examples: Sequence[tuple[str, bytes, int]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> ByteNetwork:
    """Trains on (language, slice, how often it occurs) with Adam; batches take every language alike."""
    rng = np.random.default_rng(seed)
    examples = sorted(examples)
    languages = sorted({lang for lang, _, _ in examples})
    net = ByteNetwork.fresh(languages, hidden, rng)
    if len(languages) < 2:
        return net
    by = [[w for lang, w, _ in examples if lang == name] for name in languages]
    upto = [np.cumsum([n for lang, _, n in examples if lang == name]) for name in languages]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    share = max(1, batch // len(languages))
    for step in range(1, steps + 1):
        words = [pool[i] for pool, sums in zip(by, upto, strict=True) for i in np.searchsorted(sums, rng.integers(0, sums[-1], share), side="right")]
        labels = np.repeat(np.arange(len(languages)), share)
        _, grads = net.gradients(*as_rows(words), labels)
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))  # constant, then falling to zero
        for w, g, (m, v) in zip(net.weights(), grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


@dataclass
class Reader:
    """Applies a network to texts and remembers what words add."""

    net: ByteNetwork
    memory: WordTable = field(default_factory=WordTable)

    def positions(self, text: str) -> np.ndarray:
        """The probability of each language (column) at every byte of a text."""
        slices = list(sliced(map(unit, text.split(" "))))
        found = np.empty((sum(map(len, slices)), len(self.net.languages)))
        begins = np.cumsum([0, *map(len, slices)])
        for begin in range(0, len(slices), 4096):
            p = self.net.forward(*as_rows(slices[begin : begin + 4096]))["p"]
            for i, s in enumerate(slices[begin : begin + 4096]):
                found[begins[begin + i] : begins[begin + i + 1]] = p[: len(s), i]
        return found[:-1]

    def _run(self, units: list[bytes]) -> np.ndarray:
        """For each unit: its positions' probabilities added up over letters, and the number of these."""
        cuts = [(i, u[a : a + SLICE]) for i, u in enumerate(units) for a in range(0, len(u), SLICE)]
        out = np.zeros((len(units), len(self.net.languages) + 1))
        if not self.net.languages:
            return out
        cuts.sort(key=lambda c: len(c[1]))
        for begin in range(0, len(cuts), 4096):
            few = cuts[begin : begin + 4096]
            rows, lengths = as_rows([u for _, u in few])
            run = self.net.forward(rows, lengths)
            letters = (LETTER[rows] & (run["there"] > 0)).T.astype(np.float32)
            total = np.concatenate([(run["p"] * letters[..., None]).sum(axis=0), letters.sum(axis=0)[:, None]], axis=1)
            np.add.at(out, [i for i, _ in few], total)
        return out

    def read(self, texts: Sequence[str]) -> np.ndarray:
        """For each text: probabilities added up over letters, and the number of these."""
        split = pc.split_pattern(pa.array(texts, type=pa.string()), " ")
        offsets = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        small = pc.ascii_lower(coded.dictionary).dictionary_encode()
        width = len(self.net.languages) + 1
        at = self.memory.find(small.dictionary).copy()
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new = small.dictionary.take(pa.array(unknown))
            totals = self._run(list(map(unit, new.to_pylist()))).astype(np.float32)
            at[unknown] = self.memory.add(new, totals.ravel().view(np.uint32), np.full(len(unknown), width, dtype=np.int32))
        table = self.memory.flat.view(np.float32).reshape(-1, width)[at]
        self.memory.settle()
        rows = table[small.indices.to_numpy()[coded.indices.to_numpy()]].astype(float)
        out = np.zeros((len(texts), width))
        some = np.flatnonzero(np.diff(offsets))
        if len(some):
            out[some] = np.add.reduceat(rows, offsets[:-1][some], axis=0)
        return out

    def label(self, text: str | None, total: np.ndarray) -> tuple[str, float]:
        if not text or not self.net.languages or total[-1] <= 0 or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        mean = total[:-1] / total[-1]
        best = int(np.argmax(mean))
        return self.net.languages[best], round(min(1.0, max(0.0, float(mean[best]))), 6)


def training_slices(docs: DataFrame, text_col: str, lang_col: str, draw: Column, docs_per_language: int = DOCS_PER_LANGUAGE) -> list[tuple[str, bytes, int]]:
    """(language, slice, how often) of the whole texts of about ``docs_per_language`` documents of each language: those of the smallest draws."""
    labelled = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), draw.alias("draw")).filter("lang IS NOT NULL AND text IS NOT NULL")
    shares = labelled.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(docs_per_language)) / F.count(F.lit(1))).alias("share"))
    drawn = labelled.join(stored(shares, "language-shares"), "lang")
    chosen = drawn.filter((F.shiftrightunsigned("draw", 11).cast("double") / float(1 << 53)) < F.col("share"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = pa.array(list(sliced(map(unit, text.split(" ")))), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), found], names=["lang", "slice"])

    counted = chosen.select("lang", "text").mapInArrow(cut, "lang string, slice binary").groupBy("lang", "slice").agg(F.count(F.lit(1)).alias("n"))
    table = counted.toArrow()
    return list(zip(*[table.column(c).to_pylist() for c in ("lang", "slice", "n")], strict=True))


def held_out(key: Column) -> Column:
    """One document in four is kept from training: crc32 of its key as text, mod 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE) -> ByteNetwork:
    known = docs.filter(~held_out(F.col(id_col)))
    return fit(training_slices(known, text_col, lang_col, F.xxhash64(F.col(id_col)), docs_per_language))


_READERS: dict[str, Reader] = {}


def predict(docs: DataFrame, net: ByteNetwork, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document, from its text alone."""
    import uuid

    shared, name = docs.sparkSession.sparkContext.broadcast(net), uuid.uuid4().hex

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _READERS:
            _READERS.clear()
            _READERS[name] = Reader(shared.value)
        reader = _READERS[name]
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                few = batch.slice(begin, 1000)
                texts = few.column("text").to_pylist()
                found = [reader.label(t, total) for t, total in zip(texts, reader.read([t or "" for t in texts]), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [few.column("doc_id"), few.column("held_out"), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(label, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """Trains on the documents that are not held out and labels all of them."""
    return predict(docs, train(docs, id_col, text_col, lang_col, docs_per_language), id_col, text_col)
