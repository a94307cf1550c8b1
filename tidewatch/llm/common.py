"""What several corpus operators share: reading documents, stored steps, and gapless numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

ROW = "row"  # the struct that carries an input row whole, whatever its columns are called


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read back: evaluated once, and safe when executors go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def carried(docs: DataFrame, **columns: Column) -> DataFrame:
    """The input rows packed into one struct beside working columns, so that no name can clash."""
    return docs.select(F.struct("*").alias(ROW), *[c.alias(name) for name, c in columns.items()])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text (null: empty)."""
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))


#: A key with at least one row in this many is hot. There can't be more hot keys than this, so what belongs to them may be broadcast.
HOT_PARTS = 1000


def attach(rows: DataFrame, groups: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join (inner, or left) with a table that has one row per key, when any key may hold a large part of the rows.

    Rows of hot keys meet their group by broadcast (at most HOT_PARTS groups, by arithmetic) and stay where they are;
    all others are shuffled. Both inputs are read more than once, so pass stored or checkpointed ones.
    """
    total = rows.count()
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * HOT_PARTS >= F.lit(total))
    hot = counts.select(key).checkpoint()
    known = groups.join(F.broadcast(hot), key) if how == "inner" else hot.join(groups, key, how)
    near = rows.join(F.broadcast(known), key)
    far = rows.join(F.broadcast(hot), key, "left_anti").join(groups, key, how)
    return near.unionByName(far)
