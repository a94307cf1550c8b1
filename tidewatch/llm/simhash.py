"""SimHash near-duplicates by the general pigeonhole principle.

Each document gets a 64-bit fingerprint of its word shingles; documents whose fingerprints differ in at most ``distance`` bits are
linked, and linked documents form classes.

To find the links, the 64 bits are grouped into parts of up to 16 bits so that correlated bits share a part. If each fingerprint
gives its parts thresholds whose sum is ``distance - parts + 1`` (-1: leave the part out), any fingerprint within ``distance`` agrees with
it up to the threshold in at least one part. Counts of all part values tell how many candidates a threshold would bring, and
dynamic programming picks the cheapest allocation for each fingerprint. The fingerprint then stands in the index under each
of its part values and probes the values within its thresholds.

Fingerprints that meet under one value are compared in numpy on whole bits. A bucket gives the links of a search that visits each
fingerprint once, never all pairs, and a bucket over ``BUCKET`` fingerprints is cut into chunks whose pairs are tasks of their
own. Only distinct fingerprints take part, so a group of copies of any size counts once.

What reaches the driver has a fixed size: counts of part values (at most 64/16 x 65,536 numbers) and the bits' correlations (64 x 64).

Defined cases: a null or empty text, and one without words, has fingerprint zero and is linked like any other; fewer words than a
shingle make one shingle of them all; a very long text is read whole; keys may be of any type that has an order; null keys never name a class unless all of its keys are null; repeated rows share a class;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ROW, attach, carried, partitions, stored, text_of, with_text
from tidewatch.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
BITS = 64
PART_BITS = 16
#: Fingerprints that one task compares at once; a larger bucket is compared chunk against chunk.
BUCKET = 4096
#: What one probed value costs, counted in candidates.
PROBE_COST = 2
#: Shingles whose bits are added up at once.
STRIDE = 1 << 16

_LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(starts), STRIDE):
        spans = zip(starts[at : at + STRIDE].tolist(), ends[at : at + STRIDE].tolist(), strict=True)
        hashes = np.array([xxh64_intdigest(joined[a:z], SEED) for a, z in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    chosen = np.flatnonzero(2 * ones > len(starts))
    return int(sum(1 << int(b) for b in chosen))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp``; ``fp`` is the fingerprint as a signed number."""

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found.view(np.int64))], names=["doc_id", "text_hash", "fp"]
            )

    rows = with_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(of, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def _fps(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").to_numpy().view(np.uint64)


def bit_parts(fps: DataFrame, parts: int) -> list[list[int]]:
    """Bits grouped by correlation: each part starts with the first free bit and takes the bits most correlated with it so far."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, ones, n = np.zeros((BITS, BITS)), np.zeros(BITS), 0
        for batch in batches:
            x = ((_fps(batch)[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            both += x.T @ x
            ones += x.sum(axis=0)
            n += len(x)
        if n:
            cells = np.concatenate([both.ravel(), ones, [n]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    cells = np.zeros(BITS * BITS + BITS + 1)
    for r in fps.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        cells[r["cell"]] = r["n"]
    n = max(cells[-1], 1)
    mean = cells[BITS * BITS : -1] / n
    cov = cells[: BITS * BITS].reshape(BITS, BITS) / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    free, out = list(range(BITS)), []
    for i in range(parts):
        width = BITS // parts + (i < BITS % parts)
        group = [free.pop(0)]
        while len(group) < width:
            best = max(free, key=lambda b: (corr[b, group].sum(), -b))
            free.remove(best)
            group.append(best)
        out.append(sorted(group))
    return out


def part_values(fps: np.ndarray, bits: Sequence[int]) -> np.ndarray:
    value = np.zeros(len(fps), dtype=np.int64)
    for place, bit in enumerate(bits):
        value |= ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    return value


def within(counts: np.ndarray, width: int, radius: int) -> list[np.ndarray]:
    """For radius 0, 1, ...: how many fingerprints have a value within that distance of each value."""
    values = np.arange(1 << width)
    at = [counts.astype(np.float64)] + [np.zeros(1 << width) for _ in range(radius)]
    for bit in range(width):
        flipped = values ^ (1 << bit)
        for k in range(radius, 0, -1):
            at[k] = at[k] + at[k - 1][flipped]
    return list(np.cumsum(at, axis=0))


def masks(width: int, radius: int) -> list[int]:
    """The changes of exactly ``radius`` bits."""
    out = [0]
    for _ in range(radius):
        out = [m | 1 << b for m in out for b in range(m.bit_length(), width)]
    return out


def allocate(values: Sequence[np.ndarray], near: Sequence[Sequence[np.ndarray]], widths: Sequence[int], distance: int) -> np.ndarray:
    """Thresholds (fingerprints x parts) of sum ``distance - parts + 1`` with the fewest estimated candidates."""
    parts, n = len(values), len(values[0])
    budget = distance + 1  # thresholds + 1 sum up to this
    best = np.full((n, budget + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((parts, n, budget + 1), dtype=np.int8)
    for i in range(parts):
        now = np.full((n, budget + 1), np.inf)
        signatures = 0
        for spent in range(budget + 1):
            if spent:
                signatures += len(masks(widths[i], spent - 1))
                cost = near[i][spent - 1][values[i]] + PROBE_COST * signatures
            else:
                cost = np.zeros(n)
            for total in range(spent, budget + 1):
                with_it = best[:, total - spent] + cost
                better = with_it < now[:, total]
                now[better, total] = with_it[better]
                choice[i, better, total] = spent
        best = now
    left = np.full(n, budget)
    out = np.empty((n, parts), dtype=np.int64)
    for i in range(parts - 1, -1, -1):
        spent = choice[i, np.arange(n), left]
        out[:, i] = spent - 1
        left = left - spent
    return out


def _search(fps: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray]]:
    """Links that connect all fingerprints which chains of links connect, each fingerprint found once."""
    rest = fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= distance
            if near.any():
                found, rest = rest[near], rest[~near]
                queue.extend(found)
                yield x, found


def signatures(fps: DataFrame, groups: list[list[int]], distance: int) -> DataFrame:
    """``part, value, fp, probe``: where a fingerprint is filed, and what it probes."""
    spark = fps.sparkSession
    parts, widths = len(groups), [len(g) for g in groups]

    def filed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _fps(batch)
            for i, bits in enumerate(groups):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), i)), pa.array(part_values(x, bits))], names=["part", "value"])

    counts = [np.zeros(1 << w, dtype=np.int64) for w in widths]
    found = fps.mapInArrow(filed, "part long, value long").groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).toArrow()
    part, value, n = (found.column(c).to_numpy() for c in ("part", "value", "n"))
    for i in range(parts):
        counts[i][value[part == i]] = n[part == i]
    near = spark.sparkContext.broadcast([within(c, w, distance) for c, w in zip(counts, widths, strict=True)])

    def probed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        changes = [[np.array(masks(w, r), dtype=np.int64) for r in range(distance + 1)] for w in widths]
        for batch in batches:
            x = _fps(batch)
            if not len(x):
                continue
            values = [part_values(x, bits) for bits in groups]
            limits = allocate(values, near.value, widths, distance)
            for i in range(parts):
                rows, probes, which = [np.arange(len(x))], [limits[:, i] >= 0], [values[i]]
                for radius in range(1, distance + 1):
                    who = np.flatnonzero(limits[:, i] >= radius)
                    changed = values[i][who][:, None] ^ changes[i][radius]
                    rows.append(np.repeat(who, changed.shape[1]))
                    probes.append(np.ones(changed.size, dtype=bool))
                    which.append(changed.ravel())
                at = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), i, dtype=np.int32)), pa.array(np.concatenate(which)), pa.array(x[at].view(np.int64)), pa.array(np.concatenate(probes))],
                    names=["part", "value", "fp", "probe"],
                )

    return fps.mapInArrow(probed, "part int, value long, fp long, probe boolean")


def links(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints that connect all those which chains of close fingerprints connect."""
    spark = fps.sparkSession
    parts = max(distance + 1, -(-BITS // PART_BITS))
    filed = stored(signatures(fps, bit_parts(fps, parts), distance), "signatures")
    sizes = filed.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"), F.max("probe").alias("any_probe"))
    sizes = stored(sizes.filter("n > 1 AND any_probe").select("part", "value", F.ceil(F.col("n") / bucket).cast("int").alias("chunks")), "buckets")
    keyed = filed.select(F.struct("part", "value").alias("bucket"), "fp")
    shared = attach(keyed, sizes.select(F.struct("part", "value").alias("bucket"), "chunks"), "bucket")
    # Each chunk meets every chunk of its bucket, itself included, in one task of their own.
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    met = shared.select("bucket", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    cells = met.select("fp", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("cell"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        size = 0
        held = np.empty(0, dtype=np.uint64)
        cell: int | None = None

        def one(fps: np.ndarray) -> None:
            nonlocal size
            if len(fps) > 1:
                for x, found in _search(np.unique(fps), distance):
                    a.append(np.full(len(found), x))
                    b.append(found)
                    size += len(found)

        def flush() -> pa.RecordBatch:
            nonlocal size
            out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], names=["a", "b"])
            a.clear()
            b.clear()
            size = 0
            return out

        for batch in batches:
            x, cells = _fps(batch), batch.column("cell").to_numpy()
            if not len(x):
                continue
            starts = np.concatenate([[0], np.flatnonzero(cells[1:] != cells[:-1]) + 1])
            stops = np.concatenate([starts[1:], [len(x)]])
            for s, e in zip(starts.tolist(), stops.tolist(), strict=True):
                if cell is not None and cells[s] == cell:
                    held = np.concatenate([held, x[s:e]])
                    continue
                one(held)
                held, cell = x[s:e], cells[s]
                if size > 100_000:
                    yield flush()
        one(held)
        if size:
            yield flush()

    dealt = cells.repartition(partitions(spark), "cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: ``doc_id, text_hash, fp, component_id, keep_hash``.

    ``component_id`` is the smallest ``doc_id`` of the class; with ``keep_hash``, the smallest text hash of that id, it names the
    document that stands for the class.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    fps = stored(rows.groupBy("fp").agg(first), "distinct-fingerprints")
    linked = components(links(fps.select("fp"), distance)).checkpoint()
    member = linked.withColumnRenamed("vertex", "fp").join(fps, "fp").select("root", "fp", "first").checkpoint()
    named = member.groupBy("root").agg(F.min("first").alias("first")).checkpoint()
    of_member = attach(member.select("root", "fp"), named, "root").select("fp", "first")
    alone = fps.join(linked.select(F.col("vertex").alias("fp")), "fp", "left_anti").select("fp", "first")
    classes = stored(alone.unionByName(of_member), "classes")
    return attach(rows, classes, "fp").select("doc_id", "text_hash", "fp", F.col("first.doc_id").alias("component_id"), F.col("first.text_hash").alias("keep_hash"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents that stand for their class, with all their columns; one of wholly equal rows stays."""
    mark = F.struct("doc_id", "text_hash").alias("mark")
    stands = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("keep_hash"))
    found = stored(near_duplicates(docs, id_col, text_col, shingle, distance).select(mark, stands.alias("stands")), "near-duplicates")
    # Stored, so that Spark knows their size: where few rows go, the texts of the others need no shuffle.
    goes = stored(found.filter(~F.col("stands")).select("mark").distinct(), "goes")
    again = stored(found.filter("stands").groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark"), "again")
    # Structs compare nulls as equal values.
    rows = carried(docs, mark=F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash")))
    stay = rows.join(goes, "mark", "left_anti")
    repeated = stay.join(again, "mark", "left_semi").dropDuplicates(["mark"])
    return stay.join(again, "mark", "left_anti").unionByName(repeated).select(f"{ROW}.*")
