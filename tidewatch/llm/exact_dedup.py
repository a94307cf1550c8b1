"""Exact deduplication with a two-pass Bloom filter.

Pass 1 counts, for every cell of a blocked Bloom filter, the rows whose hash falls there; the cells met
at least twice become the bits of the filter. Pass 2 probes the filter with every row: a row with a clear bit has no equal and passes straight
through, and only the possibly repeated rows are shuffled and grouped by SHA-256. A false positive costs a little shuffling and changes no result.

The filter has CELLS bits for each row, in blocks of 4 KiB that lie in a table. While it is small (BROADCAST_BYTES) it is broadcast; a larger
one is joined by block, which shuffles every row once, so that neither a driver nor a task ever holds it whole. Everything is built from DataFrame
functions.

Defined cases: a null text equals an empty one; a null ``doc_id`` sorts below every number; a very long text is hashed whole; rows repeated
with the same ``doc_id`` and text count each in ``group_size`` and exactly one of them is kept; an empty table gives
no rows; other columns are neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ROW, carried, stored, text_of

#: Bits of a block.
BITS = 32768
#: Bits of the filter for each row: about one unique row in thirty is then taken for a repeated one.
CELLS = 10
#: A filter up to this size is broadcast.
BROADCAST_BYTES = 64 << 20
#: A group with at least one row in this many is hot; there can't be more hot groups than this.
HOT_PARTS = 1000


def filter_blocks(rows: int) -> int:
    """Blocks of a filter for so many rows."""
    return max(1, -(-rows * CELLS // BITS))


def _block(h: str, blocks: int) -> Column:
    return F.pmod(F.col(h), F.lit(blocks)).cast("int")


def _places(h: str) -> list[Column]:
    """Two places in a block, from bits of the hash that the block number does not use."""
    return [F.shiftrightunsigned(F.col(h), shift).bitwiseAND(F.lit(BITS - 1).cast("long")).cast("int") for shift in (32, 47)]


def repeated_filter(hashes: DataFrame, blocks: int, h: str = "h") -> DataFrame:
    """Pass 1: ``(block, bits)`` of the cells that at least two rows fall into; at most ``blocks`` rows."""
    cells = hashes.select(_block(h, blocks).alias("block"), F.explode(F.array_distinct(F.array(*_places(h)))).alias("place"))
    twice = cells.groupBy("block", "place").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return twice.groupBy("block").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits"))


def _bit(place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.shiftright(place, 3) + 1), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place.bitwiseAND(F.lit(7))) == 1


def probe(rows: DataFrame, repeated: DataFrame, blocks: int, h: str = "h") -> DataFrame:
    """Pass 2: ``maybe`` says whether a row's hash may occur twice."""
    small = blocks * BITS // 8 <= BROADCAST_BYTES
    found = rows.withColumn("block", _block(h, blocks)).join(F.broadcast(repeated) if small else repeated.hint("merge"), "block", "left")
    first, second = _places(h)
    maybe = F.coalesce(_bit(first) & _bit(second), F.lit(False))
    return found.withColumn("maybe", maybe).drop("block", "bits")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep_id`` is the largest ``doc_id`` of the equal texts. ``blocks`` is the size of the filter if not that for the number of rows.
    """
    text = text_of(text_col)
    keys = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.unhex(F.sha2(text, 256)).alias("sha"),
            F.xxhash64(text).alias("h"),
            F.monotonically_increasing_id().alias("nth"),
        ),
        "dedup-keys",
    )
    total = keys.count()
    blocks = blocks or filter_blocks(total)
    rows = probe(keys, stored(repeated_filter(keys, blocks), "dedup-filter"), blocks).drop("h")
    if blocks * BITS // 8 > BROADCAST_BYTES:
        rows = stored(rows, "dedup-probed")
    alone = rows.filter(~F.col("maybe")).select("doc_id", "sha", "nth", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.col("nth").alias("keep_nth"))
    maybe = rows.filter("maybe").drop("maybe")
    groups = stored(
        maybe.groupBy("sha")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "nth")).alias("last"))
        .select("sha", "group_size", F.col("last.doc_id").alias("keep_id"), F.col("last.nth").alias("keep_nth")),
        "dedup-groups",
    )
    # Rows of a hot group meet their group by broadcast: hot groups are few by arithmetic. The others shuffle.
    is_hot = F.col("group_size") * HOT_PARTS >= F.lit(total)
    hot = groups.filter(is_hot).select("sha", *[F.col(c).alias(f"hot_{c}") for c in ("group_size", "keep_id", "keep_nth")])
    near = maybe.join(F.broadcast(hot), "sha", "left")
    cols = ["doc_id", "sha", "nth", "keep_id", "group_size", "keep_nth"]
    of_hot = near.filter("hot_group_size IS NOT NULL").select("doc_id", "sha", "nth", F.col("hot_keep_id").alias("keep_id"), F.col("hot_group_size").alias("group_size"), F.col("hot_keep_nth").alias("keep_nth"))
    of_cold = near.filter("hot_group_size IS NULL").select("doc_id", "sha", "nth").join(groups.filter(~is_hot), "sha").select(*cols)
    return (
        alone.select(*cols)
        .unionByName(of_hot.select(*cols))
        .unionByName(of_cold)
        .select("doc_id", "keep_id", "group_size", (F.col("nth") == F.col("keep_nth")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """The documents without copies: of equal texts the row with the largest ``doc_id`` stays, with all its columns.

    Rows that agree in ``doc_id`` and text are told apart by their other columns, and one of wholly equal rows stays.
    Which row stays is found on stored narrow keys; texts are hashed once for these, and again only where they may be repeated.
    """
    text = text_of(text_col)
    others = [F.col(c) for c in docs.columns if c != text_col]
    mark = F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(F.to_json(F.struct(*others))).alias("rest"))
    keys = stored(docs.select(F.xxhash64(text).alias("h"), F.unhex(F.sha2(text, 256)).alias("sha"), mark.alias("mark")), "dedup-keys")
    blocks = blocks or filter_blocks(keys.count())
    repeated = stored(repeated_filter(keys, blocks), "dedup-filter")
    marks = probe(keys, repeated, blocks).filter("maybe").groupBy("sha", "mark").agg(F.count(F.lit(1)).alias("n"))
    last = F.max(F.struct("mark", "n")).alias("last")
    stays = stored(marks.groupBy("sha").agg(last).select("sha", "last.*"), "dedup-groups")
    probed = probe(carried(docs, h=F.xxhash64(text), text=text, mark=mark), repeated, blocks)
    alone = probed.filter(~F.col("maybe")).select(f"{ROW}.*")
    maybe = probed.filter("maybe").select(ROW, F.unhex(F.sha2("text", 256)).alias("sha"), "mark")
    # A group's rows spread by their marks. Structs compare nulls as equal values.
    out = alone.unionByName(maybe.join(stays.filter("n = 1"), ["sha", "mark"], "left_semi").select(f"{ROW}.*"))
    equal = stays.filter("n > 1")
    if equal.isEmpty():
        return out
    # Wholly equal rows become one in every task before they meet.
    return out.unionByName(maybe.dropDuplicates(["sha", "mark"]).join(equal, ["sha", "mark"], "left_semi").select(f"{ROW}.*"))
