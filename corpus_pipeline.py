"""Corpus pipeline: from raw documents to packed training sequences.

Stages, each written as Parquet and read again as the next one's input:

1. quality rules: documents that fail, or whose host is condemned, go;
2. exact dedup: of equal texts the row with the largest ``doc_id`` stays;
3. SimHash near-dedup: of each class of near-duplicates the row with the smallest ``doc_id`` stays;
4. secret scan: secrets in the texts are masked (``n_chars`` follows), every document stays;
5. best-fit packing: token pieces with their sequence and offset.

All stages but the last return the columns of ``documents``. An empty table goes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.common import read_documents, stored
from tidewatch.llm.exact_dedup import drop_exact_copies
from tidewatch.llm.packing import pack_documents
from tidewatch.llm.quality import keep_good
from tidewatch.llm.queries import vocabulary
from tidewatch.llm.secrets import mask_secrets
from tidewatch.llm.simhash import keep_one_of_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, shingle=3, distance=3)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_secrets(docs, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = pack_documents(docs, vocabulary("word_bpe_49k.json"), 2048, keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Hashes, fingerprints and tokenizers are beyond SQL; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
