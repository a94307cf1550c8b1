"""Quality rules for documents, and rules for hosts drawn from them.

Every document gets counts and fails or passes the document rules. The failures are added up by host, each host's failure rate is shrunk
towards the common one by a beta prior whose mean and weight are fitted to all hosts (method of moments), and a
host whose rate is certain to be above the limit loses its other documents too. A host with few documents stays near
the prior and is not condemned by chance.

A host may hold any share of the rows: the sums are combined before the shuffle, and only condemned hosts are joined back, from a stored table whose
real size decides whether Spark broadcasts it.

Defined cases: a null text has no words and fails; a null host is nobody's and gets no verdict; a very long text is read whole; repeated rows are judged and
counted each; an empty table gives no rows; other columns pass through ``keep_good`` and are not read by ``judge_documents``. Text is split at ASCII white space only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import ROW, carried, stored, text_of

MIN_WORDS = 10
#: Percent of the words that may lie in repeated windows.
MAX_REPEATED = 20
WINDOW = 5
#: A host is condemned if its shrunk failure rate is above this by two standard deviations.
MAX_HOST_RATE = 0.5
#: Bounds for the prior's weight in documents.
LEAST_PRIOR, MOST_PRIOR = 1.0, 1e6

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOLS = frozenset(b"#*$%&|<>")
_NO_SYMBOLS = bytes(x for x in range(256) if x not in _SYMBOLS)


def _ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A number for each pair, equal just for equal pairs."""
    return np.unique(first * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in a run of ``window`` words that occurs at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes: dict[bytes, int] = {}
    code = np.fromiter((codes.setdefault(w, len(codes)) for w in words), dtype=np.int64, count=len(words))
    if len(codes) == len(words):
        return 0
    run = code[:n]
    for k in range(1, window):
        run = _ranks(run, code[k : k + n])
    again = np.bincount(run)[run] > 1
    # +1 where a repeated window begins, -1 behind its end.
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[:n] += again
    edge[window : window + n] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_metrics(text: str) -> tuple[int, int, int, int, int]:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    blank = len(data) - sum(map(len, words))
    seen: set[bytes] = set()
    again = 0
    for line in data.split(b"\n"):
        if line in seen:
            again += 1
        elif line and not line.isspace():
            seen.add(line)
    return len(words), len(text) - blank, len(data.translate(None, _NO_SYMBOLS)), again, repeated_words(words)


def with_metrics(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Replaces the column of whole texts by the counts; the other columns pass through."""
    kept = [f for f in rows.schema.fields if f.name != text_col]
    schema = T.StructType([*kept, *[T.StructField(m, T.LongType()) for m in METRICS]])

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_metrics(x) for x in batch.column(text_col).to_pylist()]
            counts = np.array(found, dtype=np.int64).reshape(-1, len(METRICS)).T
            columns = [batch.column(f.name) for f in kept] + [pa.array(c) for c in counts]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(measure, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def host_rates(measured: DataFrame, host_col: str = "host", failed: Column | None = None) -> DataFrame:
    """``host, n_docs, n_failed, rate, spread``: the shrunk failure rate and its standard deviation."""
    bad = base_failed() if failed is None else failed
    hosts = stored(
        measured.filter(F.col(host_col).isNotNull())
        .groupBy(F.col(host_col).alias("host"))
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(bad.cast("long")).alias("n_failed")),
        "hosts",
    )
    share = F.col("n_failed") / F.col("n_docs")
    s = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n_docs").alias("n"), F.sum("n_failed").alias("failed"), F.sum(F.col("n_failed") * share).alias("squares")).first()
    prior_mean, weight = 0.5, LEAST_PRIOR
    if s["n"]:
        # Half a document on either side keeps the mean off 0 and 1.
        prior_mean = (s["failed"] + 0.5) / (s["n"] + 1)
        within = prior_mean * (1 - prior_mean)
        between = s["squares"] / s["n"] - (s["failed"] / s["n"]) ** 2 - within * s["hosts"] / s["n"]
        weight = min(MOST_PRIOR, max(LEAST_PRIOR, within / between - 1)) if between > 0 else MOST_PRIOR
    a = F.col("n_failed") + F.lit(prior_mean * weight)
    total = F.col("n_docs") + F.lit(float(weight))
    rate = a / total
    return hosts.select("host", "n_docs", "n_failed", rate.alias("rate"), F.sqrt(rate * (1 - rate) / (total + 1)).alias("spread"))


def condemned_hosts(measured: DataFrame, host_col: str = "host", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    rates = host_rates(measured, host_col)
    return stored(rates.filter(F.col("rate") - 2 * F.col("spread") > F.lit(max_rate)).select("host"), "condemned")


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: ``doc_id``, the counts, ``base_failed`` and ``kept``."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), text_of(text_col).alias("text"))
    measured = stored(with_metrics(narrow), "quality").withColumn("base_failed", base_failed())
    condemned = condemned_hosts(measured, "host", max_rate).withColumn("condemned", F.lit(True))
    judged = measured.join(condemned, "host", "left")
    return judged.select("doc_id", *METRICS, "base_failed", (~F.col("base_failed") & F.col("condemned").isNull()).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The documents that pass, with all their columns."""
    rows = carried(docs, host=F.col(host_col).cast("string"), text=text_of(text_col))
    measured = stored(with_metrics(rows), "quality").withColumn("base_failed", base_failed())
    condemned = condemned_hosts(measured, "host", max_rate)
    return measured.filter(~F.col("base_failed")).join(condemned, "host", "left_anti").select(f"{ROW}.*")
