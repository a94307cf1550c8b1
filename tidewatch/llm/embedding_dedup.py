"""Near-duplicates among embeddings: all pairs of one label at or above a cosine, by tiles ordered along principal components.

1. All unit vectors are turned into their principal axes (second moments of all rows, one matrix that both a driver and a task can hold), so that
   few leading coordinates carry most of a product. What the others can add to a product is bounded by the norms of the two suffixes.
2. The vectors are sorted by label and by a Z-curve through the leading coordinates, where equal vectors of a label lie side by side and become
   one with a number, and cut into tiles of up to ``tile`` vectors, so a label of any size spreads over tiles of one size, and a tile is a
   small box in the leading coordinates. The one range shuffle for this is the only time that vectors are shuffled.
3. Tiles are the leaves of an implicit tree (16 neighbours make a node, and so on). Pairs of nodes are refined from the root downwards: a pair
   is dropped when its boxes and suffix norms leave no pair of vectors the required cosine. Each step is an equality join on the nodes' parents.
4. A surviving pair of tiles is one row of work, put together where both are read: a task reads a chunk of stored tiles and the files of chunks that
   it has pairs with, so the pairs, which may be as many as the square of the tiles, are neither shuffled nor written. A pair of tiles adds up
   products a few coordinates at a time and stops for rows, columns and single pairs as soon as partial product plus suffix bound is below the
   limit. This is in single precision with a bound on its rounding; what it leaves open is decided by the cosine of the original vectors in
   double precision.
5. A pair of tiles returns the number of links of each vector and a forest of links that connects what its links connect, never
   the links themselves. Connected components come from the forests.

The result is exact. Work falls with how well the leading axes tell vectors apart; vectors without any structure are all compared within their label.

Defined cases: a null label, a null vector, a zero vector and one with a null or non-finite component link with nothing; vectors of different
length are never compared; equal vectors link with each other; rows repeated with one key are vectors of their own; a null
key never names a component unless all of its keys are null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import OrderedDict, defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidewatch.llm.common import attach, partitions, scratch_path, stored
from tidewatch.llm.components import components

COSINE = 0.93
#: Vectors of a tile, and numbers in it: a tile of long vectors has fewer of them.
TILE = 1024
TILE_CELLS = 1 << 18
#: Leading coordinates that boxes and the curve know, and bits of the curve per coordinate.
LEAD = 6
CURVE_BITS = 7
#: Coordinates added up before the first test; each later test is at twice as many.
STRIDE = 24
#: Vectors that are compared with a tile at a time, so that their products stay in the processor's cache.
STRIP = 256
#: Sums in another order differ by less than this.
ROUNDING = 1e-9
#: Nodes that make one node of the next level: 2 ** FAN_BITS.
FAN_BITS = 4
#: Numbers in the tiles that are met with others as one chunk, and chunks of a job.
CHUNK_CELLS = 1 << 20
CHUNKS_AT_ONCE = 16
#: Numbers in the opened tiles that a task keeps, and bytes of pairs that it is handed at a time.
KEPT_CELLS = 1 << 22
BATCH_BYTES = 16 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``nth, vec_id, label, v``; ``v`` is null unless the vector can be compared, and of single precision if it came so."""
    single = isinstance(getattr(vectors.schema[vector_col].dataType, "elementType", None), FloatType)
    v = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    ok = F.coalesce(F.col(label_col).isNotNull() & sound, F.lit(False))
    return vectors.select(
        F.monotonically_increasing_id().alias("nth"), F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.when(ok, v).alias("v")
    )


def _unit(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors padded with zeros, the same with norm one in double precision)."""
    sizes = np.diff(lists.offsets.to_numpy())
    found = lists.flatten().to_numpy(zero_copy_only=False)
    raw = np.zeros((len(lists), width), dtype=found.dtype)
    raw[np.arange(width)[None, :] < sizes[:, None]] = found
    return raw, _normed(raw)


def _normed(raw: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    raw = raw / np.abs(raw).max(axis=1, keepdims=True).astype(float)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def content() -> Column:
    """128 bits that tell a vector of a class from all others."""
    return F.substring(F.unhex(F.sha2(F.to_json(F.struct("class", "v")), 256)), 1, 16)


def principal_axes(rows: DataFrame, width: int) -> np.ndarray:
    """Orthogonal axes (columns) by falling second moment of all unit vectors."""

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                _, unit = _unit(batch.column("v"), width)
                total += unit.T @ unit
        at = np.arange(width)
        for i in range(width):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(width, i)), pa.array(at), pa.array(total[i])], names=["i", "j", "m"])

    matrix = np.zeros((width, width))
    for r in rows.select("v").mapInArrow(moments, "i long, j long, m double").groupBy("i", "j").agg(F.sum("m").alias("m")).toLocalIterator():
        matrix[r["i"], r["j"]] = r["m"]
    _, axes = np.linalg.eigh((matrix + matrix.T) / 2)
    return np.ascontiguousarray(axes[:, ::-1])


def curve(lead: np.ndarray) -> np.ndarray:
    """Place on a Z-curve of coordinates between -1 and 1: their bits interleaved, the first coordinate's first."""
    steps = np.clip(((lead + 1) / 2 * (1 << CURVE_BITS)).astype(np.int64), 0, (1 << CURVE_BITS) - 1)
    place = np.zeros(len(lead), dtype=np.int64)
    for bit in range(CURVE_BITS - 1, -1, -1):
        for d in range(lead.shape[1]):
            place = place << 1 | steps[:, d] >> bit & 1
    return place


_TILES = "class string, block int, idx long, only boolean, ids binary, counts binary, raw binary, n int, " + ", ".join(
    f"{side}{d} double" for d in range(LEAD) for side in ("lo", "hi")
)
_PLACED = ("vid", "class", "v", "n", "same", "place")


def _merged(batch: pa.RecordBatch, at: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """The rows ``first`` of a batch with the smallest ``vid`` and the added up ``n`` of their group; ``at``: the group of each row."""
    vid, n = np.full(len(first), np.iinfo(np.int64).max), np.zeros(len(first), dtype=np.int64)
    np.minimum.at(vid, at, batch.column("vid").to_numpy())
    np.add.at(n, at, batch.column("n").to_numpy())
    out = batch.take(pa.array(first))
    for name, values in (("vid", vid), ("n", n)):
        out = out.set_column(out.schema.get_field_index(name), name, pa.array(values))
    return out


def _once(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Equal vectors of a batch in any order become one, so that of a vector with any share of the rows each task passes on few."""
    seen: dict[bytes, int] = {}
    at = np.array([seen.setdefault(x, len(seen)) for x in batch.column("same").to_pylist()])
    return batch if len(seen) == len(at) else _merged(batch, at, np.unique(at, return_index=True)[1])


def _distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted batches in which equal vectors have become one."""
    held: pa.RecordBatch | None = None  # the last vector; it may go on
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        same = batch.column("same")
        new = np.append(True, pc.not_equal(same.slice(1), same.slice(0, len(same) - 1)).to_numpy(zero_copy_only=False))
        if not new.all():
            batch = _merged(batch, np.cumsum(new) - 1, np.flatnonzero(new))
        held = batch.slice(batch.num_rows - 1)
        if batch.num_rows > 1:
            yield batch.slice(0, batch.num_rows - 1)
    if held is not None:
        yield held


def tiles(vectors: DataFrame, axes: np.ndarray, tile: int) -> DataFrame:
    """One row per tile of ``vectors`` (``vid, class, v, n``, and ``same`` if it is known) in curve order, stored, the tiles of a block in a file.

    Equal vectors become one with the smallest ``vid`` and the sum of ``n``. ``only`` says that a tile is known to hold its whole class.
    """
    width = len(axes)
    lead = min(LEAD, width)

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                batch = _once(batch)
                _, unit = _unit(batch.column("v"), width)
                place = curve(unit @ axes[:, :lead])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=list(_PLACED))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, idx, of, block, begun = 0, 0, None, 0, 0

        def flush(only: bool = False) -> pa.RecordBatch:
            nonlocal idx, size
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            raw, unit = _unit(whole.column("v"), width)
            turned = unit @ axes[:, :lead]
            row = {
                "class": of, "block": block, "idx": idx, "only": only, "n": whole.num_rows,
                "ids": whole.column("vid").to_numpy().tobytes(), "counts": whole.column("n").to_numpy().tobytes(), "raw": raw.tobytes(),
            }
            for d in range(LEAD):
                row[f"lo{d}"], row[f"hi{d}"] = (float(turned[:, d].min()), float(turned[:, d].max())) if d < lead else (0.0, 0.0)
            held.clear()
            idx, size = idx + 1, 0
            return pa.RecordBatch.from_pylist([row], schema=schema)

        def numbered() -> Iterator[pa.RecordBatch]:
            nonlocal block
            for batch in batches:
                if batch.num_rows:
                    block = batch.column("block")[0].as_py()
                yield batch

        first = True  # the first class of a block may have begun in the block before; the last may go on behind it
        for batch in _distinct(numbered()):
            classes = batch.column("class").dictionary_encode()
            codes = classes.indices.to_numpy()
            starts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
            for a, z in zip(starts, starts[1:], strict=False):
                name = batch.column("class")[a].as_py()
                if name != of:
                    if held:
                        yield flush(idx == begun and not first)
                    first, begun = of is None, idx
                of = name
                while a < z:
                    take = min(z - a, tile - size)
                    held.append(batch.slice(a, take))
                    size += take
                    a += take
                    if size == tile:
                        yield flush()
        if held:
            yield flush()

    spark = vectors.sparkSession
    known = vectors if "same" in vectors.columns else vectors.withColumn("same", content())
    kind = vectors.schema["v"].dataType.simpleString()
    found = known.select(*_PLACED[:-1]).mapInArrow(placed, f"vid long, class string, v {kind}, n long, same binary, place long")
    # The content breaks ties of the curve, so that any number of close vectors can be split, and equal ones come together.
    keys = ["class", "place", "same"]
    ranged = found.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).withColumn("block", F.spark_partition_id())
    schema = _arrow(spark, _TILES)
    return stored(ranged.mapInArrow(cut, _TILES), "embeddings-tiles")


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _boxes() -> list[str]:
    return [f"{side}{d}" for d in range(LEAD) for side in ("lo", "hi")]


def _may_link(a: str, b: str, cosine: float) -> Column:
    """Whether two boxes leave room for the cosine: by the distance of unit vectors, and by products plus suffix norms."""

    def at(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def square_least(side: str, d: int) -> Column:
        lo, hi = at(side, f"lo{d}"), at(side, f"hi{d}")
        return F.when((lo <= 0) & (hi >= 0), F.lit(0.0)).otherwise(F.least(lo * lo, hi * hi))

    apart, product = F.lit(0.0), F.lit(0.0)
    left = {side: F.lit(1.0) for side in (a, b)}
    for d in range(LEAD):
        lo_a, hi_a, lo_b, hi_b = at(a, f"lo{d}"), at(a, f"hi{d}"), at(b, f"lo{d}"), at(b, f"hi{d}")
        gap = F.greatest(lo_a - hi_b, lo_b - hi_a, F.lit(0.0))
        apart = apart + gap * gap
        product = product + F.greatest(lo_a * lo_b, lo_a * hi_b, hi_a * lo_b, hi_a * hi_b)
        left = {side: left[side] - square_least(side, d) for side in left}
    suffix = F.sqrt(F.greatest(left[a], F.lit(0.0))) * F.sqrt(F.greatest(left[b], F.lit(0.0)))
    limit = F.lit(cosine - ROUNDING)
    return (1 - apart / 2 >= limit) & (product + suffix >= limit)


def tile_pairs(cut: DataFrame, cosine: float) -> DataFrame:
    """``class, a, b`` (numbers of tiles, a <= b) of the pairs that may hold a link."""
    most = cut.agg(F.max("idx"), F.max("block")).first()
    if most[0] is None:
        return cut.select("class", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).filter("false")
    shift = FAN_BITS * math.ceil(max(most[0], 1).bit_length() / FAN_BITS)
    levels = math.ceil((shift + max(most[1], 1).bit_length()) / FAN_BITS)
    own = stored(cut.select("class", _number(shift).alias("node"), *_boxes()), "embeddings-boxes")

    def nodes(level: int) -> DataFrame:
        """Nodes of a level with their parent: the boxes of 16, 256, ... neighbouring tiles."""
        sides = [(F.min if c.startswith("lo") else F.max)(c).alias(c) for c in _boxes()]
        grouped = own.groupBy("class", F.shiftright("node", FAN_BITS * level).alias("node")).agg(*sides) if level else own
        return grouped.withColumn("parent", F.shiftright("node", FAN_BITS))

    pairs = own.select("class", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).distinct()
    for level in range(levels - 1, -1, -1):
        here = nodes(level).checkpoint()
        left = pairs.join(here.alias("x"), (F.col("x.class") == pairs["class"]) & (F.col("x.parent") == pairs["a"]))
        left = left.select(pairs["class"].alias("of"), F.col("b").alias("up"), F.struct("x.node", *[f"x.{c}" for c in _boxes()]).alias("l"))
        met = left.join(here.alias("y"), (F.col("y.class") == F.col("of")) & (F.col("y.parent") == F.col("up")) & (F.col("y.node") >= F.col("l.node")))
        pairs = met.filter(_may_link("l", "y", cosine)).select(F.col("of").alias("class"), F.col("l.node").alias("a"), F.col("y.node").alias("b")).checkpoint()
    return pairs


def _number(shift: int) -> Column:
    return F.shiftleft(F.col("block").cast("long"), shift).bitwiseOR(F.col("idx"))


def _suffix(turned: np.ndarray, end: int) -> np.ndarray:
    """Norm of the coordinates from ``end`` on."""
    return np.sqrt(np.einsum("ij,ij->i", turned[:, end:], turned[:, end:]))


def _bounded(turned: np.ndarray, end: int) -> np.ndarray:
    """The first ``end`` coordinates, and the norm of the others as one more: products of these are the most that whole products can be."""
    return np.column_stack([turned[:, :end], _suffix(turned, end)]) if end < turned.shape[1] else turned


def _scaled(raw: np.ndarray) -> np.ndarray:
    """In double precision, by a power of two that changes no digit, so that squares neither overflow nor vanish."""
    raw = raw.astype(float)
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1, keepdims=True))[1])


def linked(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray] | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of all pairs at or above ``cosine``; x and y are (original, turned) vectors, y None for pairs within x (row < column)."""
    within = y is None
    y = x if y is None else y
    a, b = (side[1].astype(np.float32, copy=False) for side in (x, y))
    # Twice what rounding of the coordinates and of sums over all of them can come to for vectors of norm one.
    slack = (a.shape[1] + 8) * 2.0**-23 + ROUNDING
    lead = [_bounded(side, min(STRIDE, a.shape[1])) for side in (a, b)]
    found = []
    for k in range(0, len(a), STRIP):
        since = k if within else 0
        i, j, s = _candidates(a[k : k + STRIP], b[since:], lead[0][k : k + STRIP], lead[1][since:], np.float32(cosine - slack))
        i, j = i + k, j + since
        if within:
            keep = i < j
            i, j, s = i[keep], j[keep], s[keep]
        found.append((i, j, s))
    i, j, s = (np.concatenate(part) for part in zip(*found, strict=True))
    sure = s >= np.float32(cosine + slack)
    near = np.flatnonzero(~sure)
    for k in range(0, len(near), 1 << 16):
        some = near[k : k + (1 << 16)]
        p, q = _scaled(x[0][i[some]]), _scaled(y[0][j[some]])
        exact = np.einsum("ij,ij->i", p, q) / (np.linalg.norm(p, axis=1) * np.linalg.norm(q, axis=1))
        sure[some] = exact >= cosine
    return i[sure], j[sure]


def _candidates(a: np.ndarray, b: np.ndarray, lead_a: np.ndarray, lead_b: np.ndarray, limit: np.float32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, columns, products) of the pairs of turned vectors at or above ``limit``; ``lead``: what the first test compares."""
    width = a.shape[1]
    rows, cols = np.arange(len(a)), np.arange(len(b))
    end = min(STRIDE, width)
    while True:
        bound = lead_a @ lead_b.T
        if bound.max() < limit:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.float32)
        alive = bound >= limit
        if end == width or 16 * np.count_nonzero(alive) < alive.size:
            break
        rows, cols = rows[alive.any(axis=1)], cols[alive.any(axis=0)]
        end = min(2 * end, width)
        lead_a, lead_b = _bounded(a[rows], end), _bounded(b[cols], end)
    i, j = np.divmod(np.flatnonzero(alive), len(cols))
    i, j, s = rows[i], cols[j], bound[i, j]
    while end < width:  # few are left: pair by pair
        end = min(2 * end, width)
        rest = _suffix(a, end)[i] * _suffix(b, end)[j] if end < width else 0
        s = np.einsum("ij,ij->i", a[i, :end], b[j, :end])
        keep = s + rest >= limit
        i, j, s = i[keep], j[keep], s[keep]
    return i, j, s


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest of the numbers below ``n`` that links connect with each."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        now = root.copy()
        np.minimum.at(now, root[i], low)
        np.minimum.at(now, root[j], low)
        while not np.array_equal(further := now[now], now):
            now = further
        if np.array_equal(now, root):
            return root
        root = now


def chunks(cut: DataFrame, pairs: DataFrame, width: int) -> list[tuple[list[str], list[str]]]:
    """Files of a chunk of tiles, and files of the chunks from this one on that hold a tile that one of its tiles has a pair with."""
    most = cut.agg(F.max("idx")).first()[0] or 0
    shift = FAN_BITS * math.ceil(max(most, 1).bit_length() / FAN_BITS)
    files: dict[int, list[str]] = defaultdict(list)
    cells: dict[int, int] = defaultdict(int)
    for block, name, n in cut.groupBy("block", F.col("_metadata.file_name").alias("name")).agg(F.sum("n")).collect():
        files[block].append(name)
        cells[block] += n * width
    chunk_of: dict[int, int] = {}
    size, last = 0, 0
    for block in sorted(cells):  # neighbours, as long as they are few
        if size and size + cells[block] > CHUNK_CELLS:
            size, last = 0, last + 1
        size += cells[block]
        chunk_of[block] = last
    of_chunk: dict[int, list[str]] = defaultdict(list)
    for block, chunk in chunk_of.items():
        of_chunk[chunk] += files[block]
    met: dict[int, set[int]] = defaultdict(set)
    blocks = [F.shiftright(c, shift).alias(c) for c in ("a", "b")]
    for a, b in pairs.filter("a != b").select(*blocks).distinct().toLocalIterator():
        met[chunk_of[a]].add(chunk_of[b])
    return [(of_chunk[c], [name for other in sorted(met[c]) for name in of_chunk[other]]) for c in sorted(met)]


def compared(cut: DataFrame, pairs: DataFrame, axes: np.ndarray, cosine: float) -> DataFrame:
    """``vid, links, root``: per pair of tiles the links of each vector that has any, and the vector that stands for what they connect."""
    width = len(axes)

    def side(batch: pa.RecordBatch, k: int, at: str) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        ids, counts, raw = (batch.column(f"{at}_{c}")[k].as_buffer() for c in ("ids", "counts", "raw"))
        ids, counts = np.frombuffer(ids, dtype=np.int64).copy(), np.frombuffer(counts, dtype=np.int64).copy()
        kind = np.float32 if len(raw) == 4 * width * len(ids) else np.float64
        raw = np.frombuffer(raw, dtype=kind).reshape(len(ids), width).copy()
        return ids, counts, (raw, (_normed(raw) @ axes).astype(np.float32))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[tuple, tuple] = OrderedDict()
        cells = 0

        def opened(batch: pa.RecordBatch, k: int, at: str) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
            """The tile of a row, turned once as long as it is kept."""
            nonlocal cells
            key = tuple(batch.column(f"{at}_{c}")[k].as_py() for c in ("block", "idx"))
            if key not in kept:
                kept[key] = side(batch, k, at)
                cells += len(kept[key][0]) * width
                while cells > KEPT_CELLS and len(kept) > 2:
                    cells -= len(kept.popitem(last=False)[1][0]) * width
            kept.move_to_end(key)
            return kept[key]

        for batch in batches:
            for k in range(batch.num_rows):
                ids, counts, x = opened(batch, k, "x")
                n = len(ids)
                if "y_idx" not in batch.schema.names:
                    i, j = linked(x, None, cosine)
                else:
                    ids_y, counts_y, y = opened(batch, k, "y")
                    i, j = linked(x, y, cosine)
                    ids, counts, j = np.append(ids, ids_y), np.append(counts, counts_y), j + n
                if not len(i):
                    continue
                links = np.bincount(i, weights=counts[j], minlength=len(ids)) + np.bincount(j, weights=counts[i], minlength=len(ids))
                root = forest(len(ids), i, j)
                met = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(ids[met]), pa.array(links[met].astype(np.int64)), pa.array(ids[root[met]])], names=["vid", "links", "root"])

    def sided(some: DataFrame, name: str) -> DataFrame:
        whole = [F.col(c).alias(f"{name}_{c}") for c in ("class", "block", "idx", "ids", "counts", "raw")]
        return some.select(*whole, F.struct(*_boxes()).alias(f"{name}_box"))

    spark = cut.sparkSession
    path = scratch_path(spark, "embeddings-links")

    def kept_links(work: DataFrame) -> None:
        before = spark.conf.get(BATCH_CONF)
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
        try:
            work.mapInArrow(run, "vid long, links long, root long").write.mode("append").option("compression", "zstd").parquet(path)
        finally:
            spark.conf.set(BATCH_CONF, before)

    kept_links(sided(cut, "x"))
    # A tile that holds its whole class has no pair with another.
    several = cut.filter("NOT only").withColumn("file", F.col("_metadata.file_name"))

    def met(own: list[str], others: list[str]) -> DataFrame:
        x, y = sided(several.filter(F.col("file").isin(own)), "x"), sided(several.filter(F.col("file").isin(others)), "y")
        later = F.struct("x_block", "x_idx") < F.struct("y_block", "y_idx")
        # Nothing stands between the join and Python, so that a pair is put together once.
        return x.hint("shuffle_replicate_nl").join(y, (F.col("x_class") == F.col("y_class")) & later & _may_link("x_box", "y_box", cosine))

    grid = chunks(cut, pairs, width)
    for k in range(0, len(grid), CHUNKS_AT_ONCE):
        some = [met(*sides) for sides in grid[k : k + CHUNKS_AT_ONCE]]
        kept_links(reduce(DataFrame.unionAll, some))
    return spark.read.schema("vid long, links long, root long").parquet(path)


def embedding_classes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, tile: int = TILE
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    name = F.concat_ws(":", F.size("v"), F.col("label"))
    rows = usable(vectors, id_col, vector_col, label_col).select("nth", "vec_id", "v", F.size("v").alias("dims"), name.alias("class"))
    rows = stored(rows.withColumn("same", F.when(F.col("v").isNotNull(), content())), "embeddings")
    sound = rows.filter("same IS NOT NULL")
    width = sound.agg(F.max("dims")).first()[0]
    alone = rows.filter("same IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if width is None:
        return alone.withColumn("kept", F.lit(True))
    # One vector stands for all equal ones; its number is that of any of their rows.
    firsts = F.min("nth").alias("vid"), F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id")).alias("first")
    distinct = sound.groupBy("same").agg(*firsts)
    axes = principal_axes(sound, width)
    cut = tiles(sound.select(F.col("nth").alias("vid"), "class", "v", F.lit(1).cast("long").alias("n"), "same"), axes, max(1, min(tile, TILE_CELLS // width)))
    found = compared(cut, tile_pairs(cut, cosine), axes, cosine)
    counts = found.groupBy("vid").agg(F.sum("links").alias("links"))
    roots = components(found.select("vid", "root")).withColumnRenamed("vertex", "vid")
    touched = stored(counts.join(roots, "vid"), "embeddings-touched")
    # The others stand alone.
    member = distinct.join(touched, "vid", "left").filter("root IS NOT NULL OR n > 1")
    member = stored(member.withColumn("root", F.coalesce("root", "vid")), "embeddings-members")
    named = member.groupBy("root").agg(F.min("first").alias("low")).checkpoint()
    classes = attach(member, named, "root").select("same", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "low")
    compared_rows = attach(sound.select("vec_id", "same"), stored(classes, "embeddings-classes"), "same", "left")
    low = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("low.vec_id"))
    out = compared_rows.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), low.alias("component_id")).unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
