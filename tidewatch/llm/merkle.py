"""A Merkle manifest of a dataset: per group a tree of digests over its rows, and one tree over the groups' roots.

Nodes carry nested intervals: a row of rank r covers ``[r, r + 1)`` of its group, and a node what its children cover. A level has a width
(16, 256, ...), and the nodes of one run share the bucket ``lo // width``. So the parent of a node is found by an equality join on (tree, bucket) of its
level with a containment test, and the siblings in a run are its members outside of the node's own interval.

Trees are built upwards, one grouping of at most 16 nodes per level. A tree ends where its first run holds one node. Proofs are handed
downwards: a run takes the steps of its parent and adds its own siblings, so no join key ever has more than 16 rows, whatever share of the rows
a group holds, and the steps above 16 rows travel once. Only the lowest runs are unfolded into rows.

Ranks come from one range shuffle of narrow rows; only the group that begins a block needs a count of the blocks before, one row per block.

Defined cases: nulls of any column have a mark of their own in the digest; a null group is a group, before all others; null keys come first in
their group; rows repeated with one key are ordered by digest; a long text is hashed whole; a lone row is its group's root; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import partitions, stored

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEPS = "array<struct<before:array<string>,after:array<string>>>"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each value as ``bytes:value``, a null as ``-``."""

    def spelled(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(F.concat(*map(spelled, fields)))


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``lo``: 0, 1, 2, ... in each group (null is one) by ``order``. The result is stored."""
    spark = rows.sparkSession
    keys = [group, *order]
    blocks = rows.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).withColumn("block", F.spark_partition_id())
    schema = T.StructType([*blocks.schema.fields, T.StructField("lo", T.LongType())])

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, begun = None, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(group)
            codes = pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1])
            sizes = np.diff(np.append(starts, len(codes)))
            lo = np.arange(len(codes)) - np.repeat(starts, sizes)
            if begun and column[0].as_py() == last:
                lo[: sizes[0]] += held
            last, held, begun = column[-1].as_py(), int(lo[-1]) + 1, True
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lo)], names=schema.names)

    numbered = stored(blocks.mapInArrow(number, schema), "merkle-ranks")
    # What the group that begins a block has in the blocks before it: one row per block.
    ends = numbered.groupBy("block").agg(F.min_by(F.struct(group), F.struct(*keys)).alias("first"), F.max_by(F.struct(group, "lo"), F.struct(*keys, "lo")).alias("end")).collect()
    before, carry, running = {}, 0, None
    for r in sorted(ends, key=lambda r: r["block"]):
        if running is not None and running[0] == r["first"][group]:
            before[r["block"]] = carry
        else:
            carry = 0
        only = r["first"][group] == r["end"][group]
        carry = (carry if only else 0) + r["end"]["lo"] + 1
        running = (r["end"][group],)
        before[r["block"]] = (before.get(r["block"], 0), r["first"][group])
    starts = spark.createDataFrame([(b, n, g) for b, (n, g) in before.items()], T.StructType([T.StructField("block", T.IntegerType()), T.StructField("_before", T.LongType()), T.StructField("_first", rows.schema[group].dataType)]))
    placed = numbered.join(F.broadcast(starts), "block")
    own = F.when(F.col(group).eqNullSafe(F.col("_first")), F.col("_before")).otherwise(F.lit(0))
    return placed.withColumn("lo", F.col("lo") + own).drop("block", "_before", "_first")


def _runs(nodes: DataFrame, width: int) -> DataFrame:
    """``tree, bucket, members, lo, hi, digest, done``: the nodes of ``tree, lo, hi, digest, ...`` in runs of one bucket."""
    members = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest", *[c for c in nodes.columns if c not in ("tree", "lo", "hi", "digest")])))
    runs = nodes.withColumn("bucket", F.floor(F.col("lo") / F.lit(width)).cast("long")).groupBy("tree", "bucket").agg(members.alias("members"))
    return runs.select(
        "tree",
        "bucket",
        "members",
        F.col("members")[0]["lo"].alias("lo"),
        F.element_at("members", -1)["hi"].alias("hi"),
        digest(F.array_join(F.col("members.digest"), "")).alias("digest"),
        # A first run of one node holds the tree's root: a run is filled before the next one begins.
        ((F.col("bucket") == 0) & (F.size("members") == 1)).alias("done"),
    )


def grown(leaves: DataFrame) -> list[DataFrame]:
    """The runs of every level, lowest first. ``leaves``: ``tree, lo, digest`` and what is to travel with them."""
    nodes = leaves.withColumn("hi", F.col("lo") + 1)
    levels = []
    width = FANOUT
    while True:
        runs = stored(_runs(nodes, width), "merkle-runs")
        levels.append(runs)
        nodes = runs.filter("NOT done").select("tree", "lo", "hi", "digest")
        if nodes.isEmpty():
            return levels
        width *= FANOUT


def tree_roots(levels: Sequence[DataFrame]) -> DataFrame:
    """``tree, digest`` of the roots."""
    found = [runs.filter("done").select("tree", F.col("members")[0]["digest"].alias("digest")) for runs in levels]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _steps_of(members: Column, lo: Column, hi: Column, done: Column, above: Column) -> Column:
    """The steps of one member of a run: its siblings (the run's intervals outside of its own), then those of the run."""
    before = F.transform(F.filter(members, lambda m: m["hi"] <= lo), lambda m: m["digest"])
    after = F.transform(F.filter(members, lambda m: m["lo"] >= hi), lambda m: m["digest"])
    own = F.array(F.struct(before.alias("before"), after.alias("after")))
    return F.when(done, above).otherwise(F.concat(own, above))


def handed_down(levels: Sequence[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest runs with ``top`` and ``above``, the steps from the run to the last root.

    ``tops`` has ``tree, top, above``: what lies above the root of each tree.
    """
    below = None
    for level in range(len(levels) - 1, -1, -1):
        runs = levels[level]
        at_root = runs.filter("done").join(tops.withColumnRenamed("tree", "of"), F.col("tree").eqNullSafe(F.col("of"))).drop("of")
        here = at_root
        if below is not None:
            width = FANOUT ** (level + 2)
            up = below.select(
                F.col("tree").alias("up_tree"), F.col("bucket").alias("up_bucket"), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"),
                F.col("members").alias("up_members"), F.col("done").alias("up_done"), F.col("top"), F.col("above").alias("up_above"),
            )
            inside = (F.col("lo") >= F.col("up_lo")) & (F.col("hi") <= F.col("up_hi"))
            same = F.col("tree").eqNullSafe(F.col("up_tree")) & (F.floor(F.col("lo") / F.lit(width)) == F.col("up_bucket"))
            met = runs.filter("NOT done").join(up, same & inside)
            steps = _steps_of(F.col("up_members"), F.col("lo"), F.col("hi"), F.col("up_done"), F.col("up_above"))
            here = met.select(*runs.columns, "top", steps.alias("above")).unionByName(at_root)
        below = stored(here, "merkle-steps") if level else here
    return below


def folded(start: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(steps, start, lambda at, s: digest(F.concat(F.array_join(s["before"], ""), at, F.array_join(s["after"], ""))))


def proofs(leaves: DataFrame) -> DataFrame:
    """Every leaf (``tree, lo, digest`` and other columns, stored) with ``subroot``, ``root`` and ``steps``, its proof."""
    levels = grown(leaves)
    roots = tree_roots(levels).select(F.col("tree").alias("of"), "digest")
    upper = grown(ranked(roots.select(F.lit(0).alias("tree"), "of", "digest"), "tree", ["of"]))
    top = tree_roots(upper).select("tree", F.col("digest").alias("top"), F.array().cast(_STEPS).alias("above"))
    last = handed_down(upper, top)
    each = last.select("top", "above", "done", "members", F.explode("members").alias("m"))
    steps = _steps_of(F.col("members"), F.col("m.lo"), F.col("m.hi"), F.col("done"), F.col("above"))
    tops = stored(each.select(F.col("m.of").alias("tree"), F.struct(F.col("m.digest").alias("subroot"), F.col("top").alias("root")).alias("top"), steps.alias("above")), "merkle-tops")
    runs = handed_down(levels, tops)
    rows = runs.select("top", "above", "done", "members", F.explode("members").alias("m"))
    steps = _steps_of(F.col("members"), F.col("m.lo"), F.col("m.hi"), F.col("done"), F.col("above"))
    return rows.select("m.*", "top.subroot", "top.root", steps.alias("steps"))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text", fields: Sequence[str] = FIELDS, tampered: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, steps, folded_root``.

    Where ``tampered`` holds, ``folded_root`` is what follows from the row with its text's ASCII letters in lower case; the proof is of
    the row as it is.
    """
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = leaf_digest([lower if f == text_col else F.col(f) for f in fields])
    narrow = docs.select(
        F.col(group_col).cast("string").alias("tree"),
        F.col(id_col).alias("doc_id"),
        leaf_digest([F.col(f) for f in fields]).alias("digest"),
        (F.lit(None).cast("string") if tampered is None else F.when(tampered, changed)).alias("changed"),
    )
    # Stored, so that the sampling of the ranges reads no texts.
    found = proofs(ranked(stored(narrow, "merkle-leaves"), "tree", ["doc_id", "digest"]))
    root = folded(F.coalesce("changed", "digest"), F.col("steps"))
    return found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "steps", root.alias("folded_root"))


def proof_digest(found: DataFrame) -> DataFrame:
    """The manifest with the digest of each proof, and whether the root that follows is the manifest's."""
    siblings = F.flatten(F.transform("steps", lambda s: F.concat(s["before"], s["after"])))
    return found.select(
        "doc_id", "leaf", "subroot", "root", digest(F.array_join(siblings, "")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
