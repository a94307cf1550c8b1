"""Best-fit packing of documents into sequences of bounded length by exact-complement hashing.

Documents become pieces of at most ``capacity`` ids. How pieces are combined depends on their lengths alone, so the plan is
made on the histogram of lengths (at most ``capacity`` numbers, whatever the corpus): indexes of single, pair and triple
sums give combinations that fill a gap exactly while pieces of these lengths are left, and what has no exact
complement is filled best-fit, with the longest piece that still fits. A combination is taken as often as its
pieces allow, so the plan stays short and describes any number of sequences.

Spark does the rest: pieces are numbered in their length class (counters in each partition, a running sum of the partitions' counts),
and (length, number) finds sequence and offset in the plan by binary search.

Defined cases: a null or empty text is the end id alone; only a document over ``capacity`` ids is cut; rows with the same id are
documents of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import stored, with_text
from tidewatch.llm.tokens import tokenizer_at

CAPACITY = 2048
#: Documents encoded at once.
DOCS = 2048
END_ID = 0

PIECES = "piece int, start long, length long, ids_crc32 long, ids binary"


class ComplementIndex:
    """Which one, two or three lengths add up to a gap, under the counts still available.

    Counts only fall, so a combination that ran out never returns, and each sum remembers how far its list is used up.
    """

    def __init__(self, counts: Mapping[int, int], capacity: int) -> None:
        self.left = [0] * (capacity + 1)
        for length, n in counts.items():
            if not 1 <= length <= capacity:
                raise ValueError(f"a piece of {length} ids does not fit {capacity}")
            self.left[length] = n
        self.pairs = list(range(-1, capacity))  # for each sum: the longer length to look at next
        self.triples = list(range(-1, capacity))

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.left[gap] else None

    def pair(self, gap: int, taken: int = 0) -> tuple[int, ...] | None:
        """Two lengths of sum ``gap``, the longer one as long as possible; one piece of length ``taken`` is spoken for."""
        left, half = self.left, (gap + 1) // 2
        a = self.pairs[gap]
        while a >= half and (not left[a] or not left[gap - a] or (2 * a == gap and left[a] < 2)):
            a -= 1
        self.pairs[gap] = a
        while a >= half:
            b = gap - a
            if left[a] >= 1 + (a == taken) + (a == b) and left[b] >= 1 + (b == taken) + (a == b):
                return a, b
            a -= 1
        return None

    def triple(self, gap: int) -> tuple[int, ...] | None:
        a = self.triples[gap]
        while a > 0:
            if self.left[a] and gap - a >= 2 and (rest := self.pair(gap - a, a)):
                self.triples[gap] = a
                return a, *rest
            a -= 1
        self.triples[gap] = 0
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        return self.single(gap) or self.pair(gap) or self.triple(gap)

    def longest(self, gap: int) -> int:
        while gap and not self.left[gap]:
            gap -= 1
        return gap


def combinations(counts: Mapping[int, int], capacity: int = CAPACITY) -> Iterator[tuple[tuple[int, ...], int]]:
    """Lengths that share a sequence, and how many sequences are made so. Uses every piece exactly once."""
    index = ComplementIndex(counts, capacity)
    left = index.left
    for length in range(capacity, 0, -1):
        while left[length]:
            left[length] -= 1
            chosen = [length]
            gap = capacity - length
            while gap:
                if exact := index.exact(gap):
                    fill, gap = exact, 0
                elif fit := index.longest(gap):
                    fill, gap = (fit,), gap - fit
                else:
                    break
                for x in fill:
                    left[x] -= 1
                chosen += fill
            need = Counter(chosen)
            more = min(left[x] // k for x, k in need.items())
            for x, k in need.items():
                left[x] -= k * more
            yield tuple(chosen), 1 + more


@dataclass(frozen=True)
class Plan:
    """For each run of pieces of one length: where its first goes. Sorted by (length, first number)."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Runs of a length begin at number 0, so the last run not behind (length, number) is of that length.
        begin = np.searchsorted(self.length, length, side="left")
        end = np.searchsorted(self.length, length, side="right")
        at = np.empty(len(length), dtype=np.int64)
        for value in np.unique(length):
            rows = np.flatnonzero(length == value)
            lo, hi = begin[rows[0]], end[rows[0]]
            at[rows] = lo + np.searchsorted(self.first[lo:hi], number[rows], side="right") - 1
        return self.sequence[at] + (number - self.first[at]), self.offset[at]


def packing_plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> Plan:
    used: Counter[int] = Counter()
    runs = []
    sequences = 0
    for lengths, times in combinations(counts, capacity):
        offset = 0
        for length in lengths:
            runs.append((length, used[length], sequences, offset))
            used[length] += times
            offset += length
        # Equal lengths in one combination take separate runs of numbers, so each run maps to consecutive sequences.
        sequences += times
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)
    return Plan(*table.T.copy())


def pieces_of(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token pieces of at most ``capacity`` ids; ``nth`` numbers those of one length in one partition (``part``)."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_at(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, DOCS):
                few = batch.slice(begin, DOCS)
                rows: list[tuple] = []
                for doc_id, ids in zip(few.column("doc_id").to_pylist(), encoder.encode(few.column("text").to_pylist()), strict=True):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        data = ids[start : start + 4 * capacity]
                        length = len(data) // 4
                        rows.append((doc_id, piece, start // 4, length, zlib.crc32(data), data if keep_ids else None, part, int(seen[length])))
                        seen[length] += 1
                if rows:
                    doc, piece, start, length, crc, data, where, nth = zip(*rows, strict=True)
                    kinds = (few.column("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                    columns = [pa.array(c, type=t) for c, t in zip((doc, piece, start, length, crc, data, where, nth), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "nth"])

    key = docs.schema[id_col].dataType.simpleString()
    return with_text(docs, id_col, text_col).mapInArrow(cut, f"doc_id {key}, {PIECES}, part int, nth long")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset``.

    ``ids`` (little-endian unsigned 32-bit) is null without ``keep_ids``, for those who only need the placement.
    """
    pieces = stored(pieces_of(docs, tokenizer, capacity, end_id, keep_ids, id_col, text_col), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # One number for each possible length: at most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = packing_plan(counts, capacity)
    numbered = pieces.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids", (F.col("nth") + F.col("before")).alias("number")
    )

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number = batch.column("number").to_numpy()
                sequence, offset = plan.place(batch.column("length").to_numpy(), number)
                columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(sequence), pa.array(offset)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"],
                )

    key = docs.schema[id_col].dataType.simpleString()
    return numbered.mapInArrow(place, f"doc_id {key}, {PIECES}, sequence_id long, offset long")
