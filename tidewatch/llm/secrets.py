"""Secret scan: fixed forms, and strings whose characters look drawn at random.

Fixed forms are assignments of a long value to a telling name, access keys and long hexadecimal numbers. Beyond these, every
long string of token characters that has letters and digits is a candidate: a window slides over it, its Shannon entropy is kept up to
date from the counts of the character that enters and the one that leaves, and is held against the limit of the window's
character class (hexadecimal or any token character). The span from the first to the last window over its limit is reported, unless the
whole candidate is on the allow-list or fixed forms cover the span. A candidate that a fixed form covers in part is measured like any other; spans may
then overlap, and masking joins them.

One projection of built-in functions: nothing is shuffled, and a row's work depends on that row's text.

Defined cases: a null text is empty and has no spans; a very long text is read whole, and one with very many matches takes time in proportion to
them; repeated rows give repeated results; an empty table gives no rows; other columns pass through ``mask_secrets`` and are not read by ``scan_secrets``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ROW, carried, text_of
from tidewatch.llm.spans import SPANS, beyond, count_of, find_spans, labelled, let, masked, spelled

# The forms and their lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # shorter runs fail anyway
MIN_ASSIGNED, MIN_ACCESS = 12, 18

#: A candidate: a whole run of token characters with a letter and a digit.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}+"
SYMBOLS = "0123456789abcdefABCDEFGHIJKLMNOPQRSTUVWXYZghijklmnopqrstuvwxyz+/_=-"
HEX_SYMBOLS = 22  # the first ones
WINDOW = 20
#: Bits per character: 20 random hexadecimal digits have about 3.4, random letters and digits about 4.1.
HEX_BITS = 3.0
TOKEN_BITS = 3.9
#: Candidates that are long and mixed for a good reason: UUIDs, checksums named as such, and words joined by marks.
#: Candidates have any length and Java recurses once per repeat of a group, except in a possessive one; no mark can be given back anyway.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"^sha(1|256|384|512)-",
    r"^[A-Za-z]{0,15}[0-9]{0,4}(?:[-_/=+][A-Za-z]{0,15}[0-9]{0,4})++$",
)
#: Entropy is added up in whole numbers of this many to the bit.
_SCALE = 1_000_000

KINDS = ("assign", "access", "hex", "entropy")


def _weights(window: int) -> list[int]:
    return [0] + [round(_SCALE * c * math.log2(c)) for c in range(1, window + 1)]


def hot_part(value: Column, window: int = WINDOW, hex_bits: float = HEX_BITS, token_bits: float = TOKEN_BITS) -> Column:
    """``(first, last)``: begin of the first and end of the last window over the limit, or null if there is none."""
    weights = F.array(*[F.lit(w).cast("long") for w in _weights(window)])
    full = round(_SCALE * window * math.log2(window))
    limits = [full - round(_SCALE * window * bits) for bits in (hex_bits, token_bits)]
    symbols = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(SYMBOLS), c) - 1)

    def over(symbols: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            came = F.get(symbols, i)
            went = F.when(i >= window, F.get(symbols, i - window)).otherwise(F.lit(-1))
            n_came = F.get(state["counts"], came)
            n_went = F.get(state["counts"], went)
            change = (
                F.when(came == went, F.lit(0).cast("long"))
                .when(went < 0, F.get(weights, n_came + 1) - F.get(weights, n_came))
                .otherwise(F.get(weights, n_came + 1) - F.get(weights, n_came) + F.get(weights, n_went - 1) - F.get(weights, n_went))
            )
            counts = F.when(came == went, state["counts"]).otherwise(
                F.transform(state["counts"], lambda n, k: n + (k == came).cast("int") - (k == went).cast("int"))
            )
            other = state["other"] + (came >= HEX_SYMBOLS).cast("int") - (went >= HEX_SYMBOLS).cast("int")

            def judged(s: Column) -> Column:
                hot = (i >= window - 1) & (s["sum"] <= F.when(s["other"] == 0, F.lit(limits[0])).otherwise(F.lit(limits[1])))
                return F.struct(
                    s["counts"].alias("counts"),
                    s["sum"].alias("sum"),
                    s["other"].alias("other"),
                    F.when(hot & (state["first"] < 0), i - (window - 1)).otherwise(state["first"]).alias("first"),
                    F.when(hot, i + 1).otherwise(state["last"]).alias("last"),
                )

            return let(F.struct(counts.alias("counts"), (state["sum"] + change).alias("sum"), other.alias("other")), judged)

        begin = F.struct(
            F.array_repeat(F.lit(0), len(SYMBOLS)).alias("counts"),
            F.lit(0).cast("long").alias("sum"),
            F.lit(0).alias("other"),
            F.lit(-1).alias("first"),
            F.lit(-1).alias("last"),
        )
        return F.aggregate(
            F.sequence(F.lit(0), F.size(symbols) - 1), begin, step, lambda s: F.when(s["first"] >= 0, F.struct(s["first"].alias("first"), s["last"].alias("last")))
        )

    return let(symbols, over)


def _base(text: Column) -> Column:
    assign = F.filter(find_spans(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= MIN_ASSIGNED)
    access = F.filter(find_spans(text, ACCESS), lambda s: s["end"] - s["start"] >= MIN_ACCESS)
    found = F.concat(labelled(assign, "assign", 0), labelled(access, "access", 1), labelled(find_spans(text, HEX), "hex", 2))
    return F.array_sort(found)


def _entropy(text: Column, base: Column, allowed: Sequence[str]) -> Column:
    candidates = find_spans(text, CANDIDATE)
    if allowed:
        known = "|".join(f"(?:{pattern})" for pattern in allowed)
        candidates = F.filter(candidates, lambda s: ~s["value"].rlike(known))
    parts = F.transform(
        candidates,
        lambda s: let(hot_part(s["value"]), lambda h: F.when(h.isNotNull(), F.struct((s["start"] + h["first"]).alias("start"), (s["start"] + h["last"]).alias("end"), s["value"].alias("value")))),
    )
    parts = F.filter(parts, lambda s: s.isNotNull()).cast(SPANS)
    return labelled(let(parts, lambda x: beyond(x, base)), "entropy", 3)


def with_secrets(rows: DataFrame, text_col: str, allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """Adds ``base`` and ``found`` (base and entropy spans): arrays of (start, order, kind, end), by start, then kind."""
    rows = rows.withColumn("base", _base(F.col(text_col)))
    return rows.withColumn("found", F.array_sort(F.concat("base", _entropy(F.col(text_col), F.col("base"), allowed))))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """``doc_id, base, found`` for every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return with_secrets(rows, "text", allowed).select("doc_id", "base", "found")


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts, the digest of the fixed forms and all spans spelled out."""
    counts = [count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("found")).alias("spans"))


def mask_secrets(
    docs: DataFrame, text_col: str = "text", length_col: str | None = None, mask: str = "[secret]", allowed: Sequence[str] = ALLOWED
) -> DataFrame:
    """The documents with every secret replaced; texts without one stay as they are, a null stays null.

    ``length_col`` names a column that holds the text's length and is to follow where the text changes.
    """
    rows = with_secrets(carried(docs, clean=text_of(text_col)), "clean", allowed)
    rows = rows.withColumn("clean", F.when(F.size("found") > 0, masked(F.col("clean"), F.col("found"), mask)))
    new = {text_col: F.col("clean")}
    if length_col:
        new[length_col] = F.length("clean").cast(docs.schema[length_col].dataType)
    old = {c: F.col(f"{ROW}.`{c}`") for c in docs.columns}
    return rows.select(*[(F.when(F.col("clean").isNotNull(), new[c]).otherwise(old[c]) if c in new else old[c]).alias(c) for c in docs.columns])
