"""How filters interact: what each one removes in every order, and its Shapley share, exactly.

Every document gets one bit per filter it fails. Which documents a set of filters (a coalition) removes follows from those
bits alone, so a part of the corpus is described by 32 counts, one per combination of bits. From them come the removals of all 32
coalitions; the step of an order is the difference of two coalitions, before and after its filter.

The Shapley values solve a constrained least-squares problem: of all additive models with ``sum(phi) = removals of all filters``
they fit the coalitions' removals best under the Shapley kernel's weights. The normal equations (with one multiplier for the
constraint) don't depend on the data, so they are solved once, in rationals, for each coalition's removals as the right-hand side; a
part's values are then whole-number combinations of its removals, with no rounding anywhere.

Texts are read once. What is shuffled has a digest, a key and a few bits per document; copies and labels are added up before each
shuffle, the join that finds the first of equal texts has the document's own key in its condition, so that a group of copies of any size
spreads over all tasks, and the 32 counts of a part are combined before they meet.

Defined cases: a null text is empty; a null part is the empty string's part; a null key is neither smaller nor larger than
any other, so its row never repeats another one and has no label; rows repeated with one key and text are counted each and don't repeat each
other; a key labelled several times is good (toxic) if one of its labels says so; a long text is read whole; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import permutations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored, text_of

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
# The limits of the filters.
MIN_WORDS = 200
MIN_DISTINCT = 50
MAX_CAPITALS = 2
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = b"#$%&*|"

_FIRST_FOUR = "digest binary, bits int, doc_id {key}, part string"


def failed_bits(data: bytes, code_points: int) -> int:
    """Bits of the filters A to D that a text fails."""
    words = data.split()
    n = len(words)
    short = n < MIN_WORDS
    poor = 100 * len(set(words)) < MIN_DISTINCT * n
    loud = 100 * (len(data) - len(data.translate(None, CAPITALS))) > MAX_CAPITALS * code_points
    signs = len(data.translate(None, SIGNS)) < len(data)
    return short | poor << 1 | loud << 2 | signs << 3


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``digest, bits, doc_id, part``: what is kept of each document."""
    rows = docs.select(text_of(text_col).alias("text"), F.col(id_col).alias("doc_id"), text_of(part_col).alias("part"))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            lengths = pc.utf8_length(texts).to_pylist()
            digests, bits = [], []
            for data, n in zip(texts.cast(pa.binary()), lengths, strict=True):
                data = data.as_py()
                digests.append(hashlib.sha256(data).digest())
                bits.append(failed_bits(data, n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(bits, pa.int32()), batch.column("doc_id"), batch.column("part")], names=["digest", "bits", "doc_id", "part"]
            )

    return rows.mapInArrow(measure, _FIRST_FOUR.format(key=rows.schema["doc_id"].dataType.simpleString()))


def with_copies(rows: DataFrame) -> DataFrame:
    """``doc_id, part, bits, n``: bit 4 is set where a smaller key has the same text; equal rows are one with their number."""
    once = stored(rows.groupBy("digest", "doc_id", "part", "bits").agg(F.count(F.lit(1)).alias("n")), "audit-texts")
    firsts = once.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
    bits = F.col("bits") + F.when(repeats, F.lit(1 << FILTERS.index("E"))).otherwise(F.lit(0))
    return once.join(firsts, ["digest", "doc_id"], "left").select("doc_id", "part", bits.alias("bits"), "n")


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, bits, n, good, toxic``: documents by the filters they fail; at most 32 rows per part."""
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    found = with_copies(measured(docs, id_col, text_col, part_col)).join(marks, "doc_id", "left")
    lost = [F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")]
    return found.groupBy("part", "bits").agg(F.sum("n").alias("n"), *lost)


def solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """``X`` of ``matrix X = right`` by elimination in rationals."""
    size = len(matrix)
    rows = [list(a) + list(b) for a, b in zip(matrix, right, strict=True)]
    for col in range(size):
        pivot = next(r for r in range(col, size) if rows[r][col])
        rows[col], rows[pivot] = rows[pivot], rows[col]
        lead = rows[col][col]
        rows[col] = [x / lead for x in rows[col]]
        for r in range(size):
            if r != col and rows[r][col]:
                factor = rows[r][col]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[col], strict=True)]
    return [row[size:] for row in rows]


def shapley_operator(players: int = len(FILTERS)) -> list[list[Fraction]]:
    """``players`` rows of one coefficient per coalition: the Shapley values as combinations of the coalitions' worths."""
    full = (1 << players) - 1
    inner = range(1, full)
    weight = {s: Fraction(players - 1, comb(players, k) * k * (players - k)) for s in inner for k in [s.bit_count()]}
    has = [[s >> i & 1 for i in range(players)] for s in range(full + 1)]
    normal = [[sum((weight[s] * has[s][i] * has[s][j] for s in inner), Fraction(0)) for j in range(players)] + [Fraction(1)] for i in range(players)]
    normal.append([Fraction(1)] * players + [Fraction(0)])
    right = [[weight[s] * has[s][i] if s in weight else Fraction(0) for s in range(full + 1)] for i in range(players)]
    right.append([Fraction(int(s == full)) for s in range(full + 1)])
    return solved(normal, right)[:players]


def order_steps() -> tuple[list[str], list[int], np.ndarray, np.ndarray, np.ndarray]:
    """All orders step by step: order, step, filter, and the coalitions before and after the step."""
    names, steps, filters, before, after = [], [], [], [], []
    for order in permutations(range(len(FILTERS))):
        done = 0
        for step, f in enumerate(order, start=1):
            names.append("".join(FILTERS[x] for x in order))
            steps.append(step)
            filters.append(f)
            before.append(done)
            done |= 1 << f
            after.append(done)
    return names, steps, np.array(filters), np.array(before), np.array(after)


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step, with the counts of ``_COUNTS``; ``shapley`` is summed over the orders."""
    counts = failure_counts(docs, labels, id_col, text_col, part_col)
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("cells"))
    names, steps, filters, before, after = order_steps()
    orders = len(names) // len(FILTERS)
    shares = [[orders * x for x in row] for row in shapley_operator()]
    if any(x.denominator != 1 for row in shares for x in row):
        raise ArithmeticError("Shapley values summed over all orders are whole numbers")
    share = np.array([[int(x) for x in row] for row in shares], dtype=np.int64)
    every = COALITIONS - 1
    alone = 1 << filters
    subsets = np.arange(COALITIONS)
    removes = ((subsets[:, None] & subsets[None, :]) != 0).astype(np.int64)  # coalition x bits

    def expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                n, good, toxic = (np.zeros(COALITIONS, dtype=np.int64) for _ in range(3))
                for cell in found:
                    n[cell["bits"]], good[cell["bits"]], toxic[cell["bits"]] = cell["n"], cell["good"], cell["toxic"]
                worth, lost_good, lost_toxic = removes @ n, removes @ good, removes @ toxic
                removed = worth[after] - worth[before]
                columns = [
                    n.sum() - worth[after],
                    removed,
                    worth[alone] - removed,
                    worth[every] - worth[every & ~alone],
                    lost_good[after] - lost_good[before],
                    lost_toxic[after] - lost_toxic[before],
                    (share @ worth)[filters],
                ]
                head = [pa.array([part] * len(names)), pa.array(names), pa.array(steps, pa.int32())]
                yield pa.RecordBatch.from_arrays([*head, *map(pa.array, columns)], names=["part", "filter_order", "step", *_COUNTS])

    return cells.mapInArrow(expand, _AUDIT)
