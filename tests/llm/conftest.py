import hashlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"

WORDS = "the quick brown fox jumps over a lazy dog while seven small birds sing about nothing in particular today".split()


def prose(seed: int, n: int) -> str:
    out = []
    for i in range(n):
        d = hashlib.md5(f"{seed}:{i}".encode()).digest()
        out.append(WORDS[d[0] % len(WORDS)] + (str(d[1]) if d[1] < 20 else ""))
    return " ".join(out)


def awkward_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, repeated rows and ids, odd white space and characters."""
    long = prose(1, 30_000)
    near = prose(2, 400)
    return [
        (1, "alpha beta"), (2, None), (3, ""), (4, "alpha beta"), (5, " \n\t "), (6, long), (7, "x" * 50_000), (8, "alpha beta"),
        (9, near), (10, near + " indeed"), (11, near.replace("the", "The")), (11, "alpha beta"), (12, prose(3, 300)), (12, prose(3, 300)),
        (12, prose(4, 200)), (13, "a\n \n b  \x1c\x0b c　d é😀 <|endoftext|> İ"), (14, long), (None, "alpha beta"), (None, None),
        (None, prose(5, 50)), (15, "it's\n" * 300), (16, "na na na na na na na na na na na na"), (17, "1234 !!! ###"), (-3, prose(6, 80)),
    ]


#: Names the operators use for themselves, and names of the output.
CLASHING = ("row", "h", "sha", "rest", "nth", "part", "block", "base", "found", "clean", "fp", "host", "n_words", "keep_id", "text_hash", "condemned", "maybe")


def with_clashes(df):
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING], F.lit(None).cast("string").alias("nothing"))


@pytest.fixture(scope="session")
def rows():
    return awkward_texts()


@pytest.fixture(scope="session")
def awkward(spark, rows):
    data = [(i, t, ("en", "de", None)[k % 3], ("src0", "src1", None)[k % 3], len(t) if t else None) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return with_clashes(df).checkpoint()


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.filter("false")


@pytest.fixture(scope="session")
def table():
    return pq.read_table(f"{SMALL}/documents.parquet").to_pylist()


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
