"""Spans of regular-expression matches in texts, as DataFrame expressions.

Spark's functions give the matches of a pattern and the texts between them, but no positions; adding up their lengths (in code points)
gives the positions. What depends on the spans before is done in one pass with a state (``scan``), spans are looked up by binary search,
and parts of a text are cut from an array of short pieces of it. So a text with very many matches takes time in proportion to
them (and the logarithm of their number).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Items that a pass collects in one inner loop, and code points of a piece of text; a power of two.
STEP = 256
_SHIFT = STEP.bit_length() - 1

SPANS = "array<struct<start:int,end:int,value:string>>"
INTERVALS = "array<struct<start:int,end:int>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where expressions aren't compiled."""
    return F.transform(F.array(value), body)[0]


def scan(items: Column, begin: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """``(s, out)``: the state behind all items, and what the steps gave, one after the other.

    ``step(state, item)`` gives a struct of ``s``, the next state, and ``out``, an array of type ``kind``. Results are put together in blocks, since
    an array grows by being copied.
    """

    def one(acc: Column, item: Column) -> Column:
        return let(step(acc["s"], item), lambda r: F.struct(r["s"].alias("s"), F.concat(acc["out"], r["out"]).alias("out")))

    def block(acc: Column, few: Column) -> Column:
        inner = F.aggregate(few, F.struct(acc["s"].alias("s"), F.array().cast(kind).alias("out")), one)
        return let(inner, lambda x: F.struct(x["s"].alias("s"), F.concat(acc["out"], F.array(x["out"])).alias("out")))

    def run(xs: Column) -> Column:
        last = F.floor((F.size(xs) - 1) / STEP).cast("int")
        blocks = F.when(F.size(xs) > 0, F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(xs, b * STEP + 1, F.lit(STEP))))
        start = F.struct(begin.alias("s"), F.array().cast(f"array<{kind}>").alias("out"))
        whole = F.aggregate(blocks, start, block, lambda r: F.struct(r["s"].alias("s"), F.flatten(r["out"]).alias("out")))
        return F.coalesce(whole, F.struct(begin.alias("s"), F.array().cast(kind).alias("out")))

    return let(items, run)


def find_spans(text: Column, pattern: str) -> Column:
    """``(start, end, value)`` of the leftmost non-overlapping matches; ``end`` is exclusive.

    The pattern must not match the empty string.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    # The text behind the last match pairs with none.
    pairs = F.zip_with(gaps, values, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("value")))
    pairs = F.filter(pairs, lambda p: p["value"].isNotNull())

    def step(at: Column, pair: Column) -> Column:
        start = at + pair["gap"]
        end = start + F.length(pair["value"])
        return F.struct(end.alias("s"), F.array(F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))).alias("out"))

    return F.when(text.rlike(pattern), scan(pairs, F.lit(0), step, SPANS)["out"]).otherwise(F.array().cast(SPANS))


def labelled(spans: Column, kind: str, order: int) -> Column:
    """The spans with their kind and its place in the list of kinds."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def spelled(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def merged(spans: Column) -> Column:
    """The intervals that spans (in any order) cover together, by start; spans that overlap or touch give one."""

    def step(open_: Column, s: Column) -> Column:
        first = open_["end"] < 0
        goes_on = ~first & (s["start"] <= open_["end"])
        now = F.struct(
            F.when(goes_on, open_["start"]).otherwise(s["start"]).alias("start"),
            F.when(goes_on, F.greatest(open_["end"], s["end"])).otherwise(s["end"]).alias("end"),
        )
        return F.struct(now.alias("s"), F.when(first | goes_on, F.array().cast(INTERVALS)).otherwise(F.array(open_)).alias("out"))

    none = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    found = let(scan(ordered, none, step, INTERVALS), lambda r: F.concat(r["out"], F.array(r["s"])))
    return F.when(F.size(spans) > 0, found).otherwise(F.array().cast(INTERVALS))


def _last_begun(intervals: Column, at: Column) -> Column:
    """The number of the last interval that begins at ``at`` or before, -1 if there is none."""

    def halve(state: Column, _: Column) -> Column:
        def at_middle(middle: Column) -> Column:
            low = F.get(intervals, middle)["start"] <= at
            return F.struct(F.when(low, middle).otherwise(state["lo"]).alias("lo"), F.when(low, state["hi"]).otherwise(middle).alias("hi"))

        return F.when(state["hi"] - state["lo"] <= 1, state).otherwise(let(F.shiftright(state["lo"] + state["hi"], 1), at_middle))

    n = F.size(intervals)
    begin = F.struct(F.lit(-1).alias("lo"), n.alias("hi"))
    return F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int")), begin, halve, lambda s: s["lo"])


def beyond(spans: Column, others: Column) -> Column:
    """The spans with a character that none of the others (in any order) has."""

    def left(intervals: Column) -> Column:
        def uncovered(s: Column) -> Column:
            return let(_last_begun(intervals, s["start"]), lambda k: (k < 0) | (F.get(intervals, k)["end"] < s["end"]))

        return F.filter(spans, uncovered)

    return F.when((F.size(spans) > 0) & (F.size(others) > 0), let(merged(others), left)).otherwise(spans)


def pieces_of_text(text: Column) -> Column:
    """The text in pieces of STEP code points, from which ``cut`` takes its parts."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STEP}}}+"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` up to ``end`` of a text in pieces, in time of their number."""
    first = F.shiftright(start, _SHIFT)
    few = F.slice(pieces, first + 1, F.shiftright(end - 1, _SHIFT) - first + 1)
    return F.when(end > start, F.substring(F.array_join(few, ""), start.bitwiseAND(F.lit(STEP - 1)) + 1, end - start)).otherwise(F.lit(""))


def masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with every span replaced by ``mask``; spans that overlap or touch give one mask."""

    def replaced(pieces: Column) -> Column:
        def of(intervals: Column) -> Column:
            def with_gap(s: Column, i: Column) -> Column:
                return F.concat(cut(pieces, F.when(i > 0, F.get(intervals, i - 1)["end"]).otherwise(F.lit(0)), s["start"]), F.lit(mask))

            rest = cut(pieces, F.element_at(intervals, -1)["end"], F.length(text))
            return F.array_join(F.concat(F.transform(intervals, with_gap), F.array(rest)), "")

        return let(merged(spans), of)

    return F.when(F.size(spans) > 0, let(pieces_of_text(text), replaced)).otherwise(text)
