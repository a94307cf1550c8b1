"""Token-id files: concatenated ids with Elias-Fano coded document boundaries.

A file is a Parquet part of blocks in ascending document order. One block holds

* ``ids``: the ids of its documents one after the other, 2 bytes each where every id of the vocabulary fits, else 4 (``width``);
* ``doc_ids``: their keys;
* ``low``, ``high``, ``samples``: where documents end, as Elias-Fano code: for n ends up to u the ``low_bits`` = log2(u / n) lowest bits
  of each end are packed side by side, the rest is a unary coded bit vector of at most 3n bits, and ``samples`` holds the place of every 64th one
  in it. ``select(k)`` therefore looks at a few bytes, and an end costs about 2 + log2(u / n) bits, not 64.

``part`` and ``first`` (ids before the block in its part) make starts global: a reader adds up one number per part.
Documents are encoded where they lie, and what is shuffled into order is their ids. The order's ranges come from a bounded sample of the keys alone,
which the ids never go through; any bounds give the same order. Spark's own writer commits the parts, so lost executors leave no half file.

Readers take offsets through the samples: for all documents of a block at once, or for the few that ``look_up`` asks for.

Defined cases: a null or empty text is the end id alone; null keys come first; rows with equal keys follow each other
in the order of the input; an empty table gives files without blocks; other columns are not written.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import partitions, stored, with_text
from tidewatch.llm.tokens import tokenizer_at

END_ID = 0
#: A block is closed at so many ids or documents; a longer document is a block of its own.
BLOCK_IDS = 1 << 20
BLOCK_DOCS = 1 << 14
SAMPLE = 64
#: Ids in one Arrow buffer; a longer document has a buffer of its own.
GROUP_IDS = 1 << 24
#: Documents encoded at once, and characters whose pieces are looked up at once.
DOCS = 4096
STRIDE = 1 << 24
#: Keys sampled for each part's bounds.
SAMPLED = 100

BLOCKS = (
    "part int, block int, first long, n_ids long, n_docs int, width int, doc_ids array<{}>, "
    "low_bits int, low binary, high binary, samples binary, ids binary"
)


@dataclass(frozen=True)
class EliasFano:
    """A non-decreasing sequence of numbers."""

    n: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        values = values.astype(np.int64)
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (values >> low_bits) + np.arange(n)
        vector = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        vector[ones] = 1
        return cls(n, low_bits, low, np.packbits(vector, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes())

    def select(self, k: int) -> int:
        """The k-th number, from the nearest sample and the few bytes behind it."""
        if not 0 <= k < self.n:
            raise IndexError(k)
        at = int(np.frombuffer(self.samples, dtype="<u4")[k // SAMPLE])
        missing = k % SAMPLE
        while missing:
            at += 1
            missing -= self.high[at >> 3] >> (at & 7) & 1
        low = 0
        for j in range(self.low_bits):
            bit = k * self.low_bits + j
            low |= (self.low[bit >> 3] >> (bit & 7) & 1) << j
        return (at - k) << self.low_bits | low

    def select_many(self, ks: np.ndarray) -> np.ndarray:
        """The numbers of many places, each from its nearest sample."""
        ks = np.asarray(ks, dtype=np.int64)
        if not len(ks):
            return np.empty(0, dtype=np.int64)
        if ks.min() < 0 or ks.max() >= self.n:
            raise IndexError("no such number")
        high = np.frombuffer(self.high, dtype=np.uint8)
        begin = np.frombuffer(self.samples, dtype="<u4").astype(np.int64)[ks // SAMPLE]
        missing = ks % SAMPLE  # ones to pass behind the sample
        byte = begin >> 3
        bits = high[byte] & (0xFF << (begin & 7)).astype(np.uint8)
        ones = np.empty(len(ks), dtype=np.int64)
        looking = np.arange(len(ks))
        while len(looking):
            held = np.bitwise_count(bits)
            here = missing < held
            ones[looking[here]] = 8 * byte[here] + _NTH_ONE[bits[here], missing[here]]
            on = ~here
            looking, missing, byte = looking[on], missing[on] - held[on], byte[on] + 1
            bits = high[byte]
        return (ones - ks) << self.low_bits | self._low(ks)

    def _low(self, ks: np.ndarray) -> np.ndarray:
        """The low bits at many places, from the bytes that hold them."""
        if not self.low_bits:
            return np.zeros(len(ks), dtype=np.int64)
        first = ks * self.low_bits
        low = np.frombuffer(self.low, dtype=np.uint8)
        out = np.zeros(len(ks), dtype=np.int64)
        for j in range((self.low_bits + 14) // 8):
            at = (first >> 3) + j
            out |= np.where(at < len(low), low[np.minimum(at, len(low) - 1)], 0).astype(np.int64) << 8 * j
        return out >> (first & 7) & (1 << self.low_bits) - 1


def _nth_ones() -> np.ndarray:
    """For each byte: the places of its ones in order."""
    out = np.zeros((256, 8), dtype=np.int64)
    for value in range(256):
        places = [bit for bit in range(8) if value >> bit & 1]
        out[value, : len(places)] = places
    return out


_NTH_ONE = _nth_ones()


def _block(part: int, block: int, first: int, width: int, doc_ids: pa.Array, ids: bytes, ends: np.ndarray) -> pa.RecordBatch:
    ef = EliasFano.of(ends)
    row = {
        "part": [part], "block": [block], "first": [first], "n_ids": [int(ends[-1])], "n_docs": [len(ends)], "width": [width],
        "low_bits": [ef.low_bits], "low": [ef.low], "high": [ef.high], "samples": [ef.samples], "ids": [ids],
    }
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4)
    columns = {c: pa.array(v, type=t) for (c, v), t in zip(row.items(), kinds, strict=True)}
    columns["doc_ids"] = pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids)
    names = [x.split()[0] for x in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)


def _binaries(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    """One binary value per end (in bytes) from one buffer."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _key(doc_id: object, nth: int) -> tuple:
    return (False, 0, nth) if doc_id is None else (True, doc_id, nth)


def _bounds(keyed: DataFrame, parts: int) -> list[tuple]:
    """The first keys of all parts but the first, from the keys whose numbers hash lowest: a sample of bounded size."""
    few = keyed.orderBy(F.xxhash64("nth"), "nth").limit(SAMPLED * parts).collect()
    found = sorted(_key(r["doc_id"], r["nth"]) for r in few)
    return sorted({found[len(found) * p // parts] for p in range(1, parts)}) if found else []


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every document, appends ``end_id`` and writes the files in ascending ``doc_id`` order."""
    spark = docs.sparkSession
    parts = partitions(spark)
    keyed = with_text(docs, id_col, text_col).withColumn("nth", F.monotonically_increasing_id())
    bounds = _bounds(keyed.select("doc_id", "nth"), parts)
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_at(tokenizer)
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        for batch in batches:
            for begin in range(0, batch.num_rows, DOCS):
                few = batch.slice(begin, DOCS)
                keys = zip(few.column("doc_id").to_pylist(), few.column("nth").to_pylist(), strict=True)
                part = [bisect_right(bounds, _key(*k)) for k in keys]
                # Cut where the sum passes a bound, as one buffer holds at most 2 GB.
                raw = encoder.encode(few.column("text").to_pylist(), STRIDE)
                sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4 + 1
                group = np.cumsum(sizes) // GROUP_IDS
                cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(raw)]
                for a, z in zip(cuts, cuts[1:], strict=False):
                    flat = np.frombuffer(end.join([*raw[a:z], b""]), dtype="<u4").astype(f"<u{width}")
                    columns = [pa.array(part[a:z], pa.int32()), few.column("doc_id").slice(a, z - a), few.column("nth").slice(a, z - a)]
                    ids = _binaries(np.cumsum(sizes[a:z]) * width, flat)
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([width] * (z - a), pa.int32()), ids], names=["part", "doc_id", "nth", "width", "ids"])

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = -1
        block = first = 0
        width = 4
        doc_ids: list[pa.Array] = []
        ids: list[bytes] = []
        sizes: list[np.ndarray] = []
        n_ids = n_docs = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, first, n_ids, n_docs
            out = _block(part, block, first, width, pa.concat_arrays(doc_ids), b"".join(ids), np.cumsum(np.concatenate(sizes)))
            block, first, n_ids, n_docs = block + 1, first + n_ids, 0, 0
            for held in (doc_ids, ids, sizes):
                held.clear()
            return out

        for batch in batches:
            of = batch.column("part").to_numpy()
            values = batch.column("ids")
            data = values.buffers()[2]
            if not batch.num_rows:
                continue
            width = batch.column("width")[0].as_py()
            ends = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
            a = 0
            while a < len(of):
                if of[a] != part:
                    if n_docs:
                        yield flush()
                    part, block, first = int(of[a]), 0, 0
                # As many documents of this part as the block still takes, one at least.
                z = int(np.searchsorted(of, part, side="right"))
                room = int(np.searchsorted(ends[a + 1 : z + 1], ends[a] + width * (BLOCK_IDS - n_ids), side="right"))
                z = min(z, a + min(room, BLOCK_DOCS - n_docs))
                if z == a:
                    if n_docs:
                        yield flush()
                        continue
                    z = a + 1
                doc_ids.append(batch.column("doc_id").slice(a, z - a))
                ids.append(data[int(ends[a]) : int(ends[z])].to_pybytes())
                sizes.append(np.diff(ends[a : z + 1]) // width)
                n_ids += int(ends[z] - ends[a]) // width
                n_docs += z - a
                a = z
        if n_docs:
            yield flush()

    kind = docs.schema[id_col].dataType.simpleString()
    coded = keyed.mapInArrow(encode, f"part int, doc_id {kind}, nth long, width int, ids binary")
    ordered = coded.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id", "nth")
    ordered.mapInArrow(collect, BLOCKS.format(kind)).write.option("compression", "zstd").parquet(path)


def _before_parts(files: DataFrame) -> dict[int, int]:
    """What lies before each part: one number per part."""
    sizes = {r["part"]: r["n"] for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(sizes):
        before[part], total = total, total + sizes[part]
    return before


def _opened(batch: pa.RecordBatch, i: int) -> tuple[EliasFano, np.ndarray, int, int]:
    """(ends, ids, part, first) of one block."""
    row = {c: batch.column(c)[i].as_py() for c in ("part", "first", "n_docs", "width", "low_bits", "low", "high", "samples", "ids")}
    ends = EliasFano(row["n_docs"], row["low_bits"], row["low"], row["high"], row["samples"])
    return ends, np.frombuffer(row["ids"], dtype=f"<u{row['width']}"), row["part"], row["first"]


def _places(ends: EliasFano, ks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of documents of a block."""
    stops = ends.select_many(ks)
    return np.where(ks > 0, ends.select_many(np.maximum(ks - 1, 0)), 0), stops


def _read(files: DataFrame, value: Callable[[np.ndarray, np.ndarray, np.ndarray], pa.Array], ddl: str) -> DataFrame:
    """``doc_id, start, n_tokens`` and what ``value`` makes of a block's ids, the begins and the ends, for every document."""
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    before = _before_parts(files)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ends, ids, part, first = _opened(batch, i)
                stops = ends.select_many(np.arange(ends.n))
                starts = np.concatenate([[0], stops[:-1]])
                columns = [batch.column("doc_ids")[i].values, pa.array(starts + (before[part] + first)), pa.array(stops - starts), value(ids, starts, stops)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", ddl.split()[0]])

    return files.mapInArrow(decode, f"doc_id {kind}, start long, n_tokens long, {ddl}")


def _as_binary(ids: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    wide = ids.astype("<u4").tobytes()
    return pa.array([wide[4 * a : 4 * z] for a, z in zip(starts.tolist(), stops.tolist(), strict=True)], type=pa.binary())


def _as_crc32(ids: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    wide = memoryview(ids.astype("<u4")).cast("B")
    return pa.array([zlib.crc32(wide[4 * a : 4 * z]) for a, z in zip(starts.tolist(), stops.tolist(), strict=True)], type=pa.int64())


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of each document; ``ids`` are little-endian unsigned 32-bit integers."""
    return _read(spark.read.parquet(path), _as_binary, "ids binary")


def token_file_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document; the ids themselves stay where they are read."""
    return _read(spark.read.parquet(path), _as_crc32, "ids_crc32 long")


def look_up(spark: SparkSession, path: str, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of the documents whose keys ``wanted`` has, each file document once.

    Keys find (block, place) first; only blocks that hold a wanted document are opened, and only its ends are selected.
    """
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    before = _before_parts(files)
    held = files.select("part", "block", F.posexplode("doc_ids").alias("k", "doc_id"))
    found = held.join(wanted.select(F.col(id_col).alias("doc_id")).distinct(), "doc_id", "left_semi")
    places = stored(found.groupBy("part", "block").agg(F.sort_array(F.collect_list("k")).alias("ks")), "token-places")

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ends, ids, part, first = _opened(batch, i)
                ks = batch.column("ks")[i].values.to_numpy().astype(np.int64)
                starts, stops = _places(ends, ks)
                columns = [batch.column("doc_ids")[i].values.take(pa.array(ks)), pa.array(starts + (before[part] + first)), pa.array(stops - starts)]
                yield pa.RecordBatch.from_arrays([*columns, _as_binary(ids, starts, stops)], names=["doc_id", "start", "n_tokens", "ids"])

    return files.join(places, ["part", "block"]).mapInArrow(decode, f"doc_id {kind}, start long, n_tokens long, ids binary")
