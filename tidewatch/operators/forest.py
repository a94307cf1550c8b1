"""Isolation forest (Liu, Ting and Zhou 2008): trees grown on small hash samples, scored as a vectorized column.

A fitted forest has at most ``n_trees * 2 * sample`` nodes however large the training data, so it can be
shipped to every task.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.scalars import num_default
from tidewatch.operators.timeline import exact_percentile

NODE_SCHEMA = (
    "tree_id int, node_id int, feature int, threshold double, left int, right int, size int, depth int"
)


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends only on the given values."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def tree_samples(df: DataFrame, n_rows: int, n_trees: int, sample: int, seed: int, seq: str) -> DataFrame:
    """The rows that may belong to a tree's sample, with ``tree_id`` and the draw ``_u`` that orders them.

    Each (row, tree) has a draw that hangs on ``seq`` alone, so a repeated task draws the same. Draws below a limit that
    leaves every tree ``sample`` rows with near certainty are kept; a row is copied only for trees that take it.
    """
    want = sample + 6 * math.sqrt(sample) + 30
    limit = min(1.0, want / n_rows)

    def draw(tree: Column) -> Column:
        return _uniform(F.col(seq), tree, F.lit(seed))

    taking = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: draw(t) < limit)
    return df.withColumn("tree_id", F.explode(taking)).withColumn("_u", draw(F.col("tree_id")))


def grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes (node_id, feature, threshold, left, right, size, depth); a leaf has feature -1."""
    nodes: list[list] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append([at, -1, 0.0, -1, -1, len(rows), depth])
        part = x[rows]
        low, high = (part.min(axis=0), part.max(axis=0)) if len(rows) else (np.zeros(0), np.zeros(0))
        varying = np.flatnonzero(high > low)
        if depth < max_depth and len(varying):
            feature = int(varying[rng.integers(len(varying))])
            cut = float(rng.uniform(low[feature], high[feature]))
            goes_left = part[:, feature] <= cut
            nodes[at][1:3] = feature, cut
            nodes[at][3] = grow(rows[goes_left], depth + 1)
            nodes[at][4] = grow(rows[~goes_left], depth + 1)
        return at

    grow(np.arange(len(x)), 0)
    return [tuple(n) for n in nodes]


@dataclass(frozen=True)
class ForestModel:
    """A fitted forest as a table of nodes, its features, sample size and score offset."""

    nodes: pd.DataFrame
    features: tuple[str, ...]
    sample: int
    offset: float = 0.0

    def _arrays(self) -> tuple[np.ndarray, ...]:
        trees = sorted(self.nodes.tree_id.unique())
        width = int(self.nodes.node_id.max()) + 1
        shape = (len(trees), width)
        feature, left, right = np.zeros(shape, int), np.zeros(shape, int), np.zeros(shape, int)
        threshold, path = np.zeros(shape), np.zeros(shape)
        row = {t: i for i, t in enumerate(trees)}
        for n in self.nodes.itertuples(index=False):
            i, leaf = row[n.tree_id], n.feature < 0
            # A leaf points to itself, so every row can take the same number of steps.
            feature[i, n.node_id] = 0 if leaf else n.feature
            left[i, n.node_id] = n.node_id if leaf else n.left
            right[i, n.node_id] = n.node_id if leaf else n.right
            threshold[i, n.node_id] = n.threshold
            path[i, n.node_id] = n.depth + average_path(n.size)
        return feature, threshold, left, right, path

    def raw_score(self, df: DataFrame) -> Column:
        """Column with minus the anomaly score of the paper: near -1 for outliers, about -0.5 and up otherwise."""
        shared = df.sparkSession.sparkContext.broadcast(self._arrays())
        depth, norm = int(self.nodes.depth.max()), average_path(self.sample)

        def score(*columns: pd.Series) -> pd.Series:
            feature, threshold, left, right, path = shared.value
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for f, cut, lo, hi, length in zip(feature, threshold, left, right, path, strict=True):
                node = np.zeros(len(x), dtype=int)
                for _ in range(depth):
                    node = np.where(x[rows, f[node]] <= cut[node], lo[node], hi[node])
                total += length[node]
            mean = total / len(feature)
            return pd.Series(-np.exp2(-mean / norm) if norm else np.full(len(x), -0.5))

        udf = F.pandas_udf(score, "double")
        return udf(*[num_default(c) for c in self.features])

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``anomaly_score`` (lower is more anomalous) and ``is_anomaly`` (score below 0)."""
        out = df.withColumn("anomaly_score", self.raw_score(df) - F.lit(self.offset))
        return out.withColumn("is_anomaly", F.col("anomaly_score") < 0)

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {"features": list(self.features), "sample": self.sample, "offset": self.offset}
        table = spark.createDataFrame(self.nodes, NODE_SCHEMA).withColumn("meta", F.lit(json.dumps(meta)))
        table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        table = spark.read.parquet(path).toPandas()
        meta = json.loads(table.meta.iloc[0])
        return cls(table.drop(columns="meta"), tuple(meta["features"]), meta["sample"], meta["offset"])


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    n_trees: int = 100,
    sample: int = 256,
    contamination: float = 0.05,
    seed: int = 42,
    seq: str = "seq",
) -> ForestModel:
    """Fit on the rows of ``df``; ``seq`` identifies a row. Missing feature values count as 0.

    The offset puts the ``contamination`` share of the training rows below 0. Runs jobs over ``df``: one
    to count, one to sample, two to place the offset.
    """
    x = df.select(seq, *[num_default(c).alias(c) for c in features])
    n_rows = x.count()
    if n_rows == 0:
        raise ValueError("no training rows")
    size = min(sample, n_rows)
    max_depth = math.ceil(math.log2(max(size, 2)))
    names = list(features)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf.tree_id.iloc[0])
        chosen = pdf.sort_values(["_u", seq]).head(size)
        if len(chosen) < size:
            raise ValueError(f"tree {tree} has {len(chosen)} of {size} rows; {seq} must identify rows")
        rng = np.random.default_rng([seed, tree])
        nodes = grow_tree(chosen[names].to_numpy(dtype=float), rng, max_depth)
        table = pd.DataFrame(nodes, columns=["node_id", "feature", "threshold", "left", "right", "size", "depth"])
        table.insert(0, "tree_id", tree)
        return table

    drawn = tree_samples(x, n_rows, n_trees, size, seed, seq)
    # The samples are small, so adaptive execution would put all trees into one task; a fixed number stays.
    slots = min(n_trees, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    nodes = drawn.repartition(slots, "tree_id").groupBy("tree_id").applyInPandas(build, NODE_SCHEMA).toPandas()
    if nodes.tree_id.nunique() < n_trees:
        raise ValueError(f"{nodes.tree_id.nunique()} of {n_trees} trees have rows; {seq} must identify rows")
    model = ForestModel(nodes, tuple(features), size)
    scores = x.select(model.raw_score(x).alias("s"))
    offset = exact_percentile(scores, "s", contamination).first()[0]
    return ForestModel(nodes, tuple(features), size, float(offset))
