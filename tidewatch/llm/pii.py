"""Personal data: fixed forms, and identifiers found by the words they stand behind.

E-mail addresses, IP numbers, payment cards and telephone numbers are found by their form. They are also seeds: the words before a
seed make a lexical pattern, and a pattern that mostly stands before identifiers is trusted to name others whose form nobody wrote
down. Patterns and identifier-like strings make a graph whose edges count how often a pattern stands before a string. Each round scores a pattern by
the share of trusted strings behind it, and an unknown string by the patterns it stands behind; a string of high score is a seed of the
next round, so that it induces patterns of its own. Two words with too few seeds behind them back off to the last one. At the end, unknown
strings behind patterns of high confidence are reported as ``context`` spans.

The graph holds only strings with digits and the words before them. It is built from DataFrame functions and lives in stored tables;
a pattern or string may own any share of the edges (sums are combined before the shuffle, joins go through ``attach``).

Defined cases: a null text is empty and has no spans; a very long text is read whole, and one with very many matches takes time in proportion to
them; repeated rows are found each, and count each in the graph; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import attach, stored, text_of
from tidewatch.llm.spans import beyond, count_of, cut, find_spans, let, pieces_of_text, spelled

# The forms. A run of the first class can only succeed from its first character, so the search does not begin inside one,
# which keeps long runs cheap; a match may begin where the last one ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"  # shorter ones fail anyway
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

KINDS = ("email", "ip", "card", "phone")

#: A whole run of identifier characters that has a digit, of any length, unless a letter of another alphabet goes on with it.
RUN = r"(?<![\p{L}0-9._@:/-])(?=[A-Za-z._@:/-]*+[0-9])[A-Za-z0-9._@:/-]++(?:(?<![A-Za-z0-9])|(?!\p{L}))"
#: What is not part of the identifier-like string in a run: marks and labels (words with a colon, but no pairs of hexadecimal digits) before it,
#: marks behind it.
LEAD = r"^(?:[._@:/-]++|(?![A-Fa-f]{2}:[0-9A-Fa-f]{2}(?::|$))[A-Za-z]++:)*+"
TRAIL = r"(?<![._@:/-])[._@:/-]++$"
MIN_IDENTIFIER = 6
#: Up to two words right before a string, with at most three other characters behind each.
BEFORE = r"(?:(\p{L}{1,30})[^\p{L}0-9]{1,3})?(\p{L}{1,30})[^\p{L}0-9]{1,3}$"
REACH = 70

_SEEN = "array<struct<pattern:string,instance:string,start:int,end:int,seed:boolean>>"

ROUNDS = 3
#: What a pattern of no evidence weighs against the evidence there is.
DOUBT = 2.0
#: A pattern must stand before so many different seeds (forms, or strings found in an earlier round), and reach this confidence, to name new identifiers.
MIN_SEEDS = 5
MIN_CONFIDENCE = 0.8
#: Confidence from which a pattern adds to the score of a string.
HEARD = 0.5
#: Score from which a string found in one round is a seed of the next, with the score of one.
KNOWN = 0.8


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn's check: from the right, every second one doubled, the digit sums in tens."""

    def add(total: Column, k: Column) -> Column:
        d = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        return total + F.when(k % 2 == 0, d).otherwise(2 * d - F.when(d > 4, F.lit(9)).otherwise(F.lit(0)))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _small(part: Column) -> Column:
    """At most 255, whatever zeros stand before."""
    number = F.regexp_replace(part, "^0+", "")
    return (F.length(number) <= 2) | ((F.length(number) == 3) & (number <= "255"))


def base_spans(text: Column) -> Column:
    """``(order, start, kind, end, value)`` of the fixed forms, by kind, then start."""
    email = find_spans(text, EMAIL)
    ip = F.filter(find_spans(text, IP), lambda s: F.forall(F.split(s["value"], r"\."), _small))
    card = F.filter(find_spans(text, CARD), lambda s: F.length(_digits(s["value"])).between(13, 19))
    card = F.filter(card, lambda s: _luhn(_digits(s["value"])))
    phone = F.filter(find_spans(text, PHONE), lambda s: F.length(_digits(s["value"])).between(9, 15))

    def of(spans: Column, order: int) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(F.lit(order).alias("order"), s["start"].alias("start"), F.lit(KINDS[order]).alias("kind"), s["end"].alias("end"), s["value"].alias("value")),
        )

    return F.concat(*[of(spans, i) for i, spans in enumerate((email, ip, card, phone))])


def _in_context(text: Column, spans: Column, seed: bool) -> Column:
    """Spans with the lower-case words before them, where there are any."""

    def pattern(pieces: Column, s: Column) -> Column:
        before = F.lower(cut(pieces, F.greatest(s["start"] - REACH, F.lit(0)), s["start"]))
        return let(before, lambda b: F.trim(F.concat_ws(" ", F.regexp_extract(b, BEFORE, 1), F.regexp_extract(b, BEFORE, 2))))

    def with_words(pieces: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                pattern(pieces, s).alias("pattern"), F.lower(s["value"]).alias("instance"), s["start"].alias("start"), s["end"].alias("end"), F.lit(seed).alias("seed")
            ),
        )

    seen = F.when(F.size(spans) > 0, let(pieces_of_text(text), with_words)).otherwise(F.array().cast(_SEEN))
    return F.filter(seen, lambda s: s["pattern"] != "")


def identifiers(text: Column) -> Column:
    """The identifier-like strings: at least six characters with a digit, begun and ended by a letter or digit."""

    def trimmed(s: Column) -> Column:
        lead, trail = F.length(F.regexp_extract(s["value"], LEAD, 0)), F.length(F.regexp_extract(s["value"], TRAIL, 0))
        size = F.length(s["value"]) - lead - trail
        return F.struct((s["start"] + lead).alias("start"), (s["end"] - trail).alias("end"), F.substring(s["value"], lead + 1, size).alias("value"))

    return F.filter(F.transform(find_spans(text, RUN), trimmed), lambda s: s["end"] - s["start"] >= MIN_IDENTIFIER)


def _last_word(pattern: Column) -> Column:
    return F.substring_index(pattern, " ", -1)


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, nth, base, seen``, stored: the fixed forms of each document, and all strings with the words before them."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("nth"), text_of(text_col).alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    text, base = F.col("text"), F.col("base")
    # What a fixed form covers in part is an identifier of its own.
    unknown = let(identifiers(text), lambda found: beyond(found, base))
    rows = rows.withColumn("seen", F.concat(_in_context(text, base, True), let(unknown, lambda found: _in_context(text, found, False))))
    slim = F.transform(base, lambda s: F.struct(s["order"].alias("order"), s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return stored(rows.select("doc_id", "nth", slim.alias("base"), "seen"), "pii")


def _backed_off(patterns: DataFrame, min_seeds: int) -> DataFrame:
    """``pattern, by, confidence``: each pattern that has seeds enough by itself, any other by its last word where that has."""
    enough = patterns.filter(F.col("seeds") >= min_seeds)
    own = enough.select("pattern", F.col("pattern").alias("by"), "confidence")
    poor = patterns.filter((F.col("seeds") < min_seeds) & F.col("pattern").contains(" ")).select("pattern", _last_word(F.col("pattern")).alias("by")).checkpoint()
    words = enough.filter(~F.col("pattern").contains(" ")).select(F.col("pattern").alias("by"), "confidence").checkpoint()
    return own.unionByName(attach(poor, words, "by").select("pattern", "by", "confidence")).checkpoint()


def trusted_patterns(
    seen: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE, known: float = KNOWN
) -> DataFrame:
    """``pattern, confidence`` of the patterns that may name identifiers, from rows ``pattern, instance, seed``.

    A pattern of two words with too few seeds has the confidence of its last word, which counts all that stands behind that word.
    """
    counted = seen.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"))
    both = F.array_distinct(F.array("pattern", _last_word(F.col("pattern"))))
    levels = counted.select(F.explode(both).alias("level"), "pattern", "instance", "n", "seed")
    grouped = levels.groupBy(F.col("level").alias("pattern"), "instance")
    # own: the pattern is the longest one right before the string, somewhere.
    edges = stored(grouped.agg(F.sum("n").alias("n"), F.max("seed").alias("seed"), F.max(F.col("level") == F.col("pattern")).alias("own")), "pii-edges")
    scores = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score")).checkpoint()
    patterns = None
    for last in [False] * (rounds - 1) + [True]:
        weighed = attach(edges, scores, "instance")
        found = (F.col("score") == 1).cast("int")
        sums = weighed.groupBy("pattern").agg(F.sum(F.col("n") * F.col("score")).alias("good"), F.sum("n").alias("all"), F.sum(found).alias("seeds"))
        sums = sums.select("pattern", "seeds", F.round(F.col("good") / (F.col("all") + DOUBT), 6).alias("confidence")).checkpoint()
        patterns = _backed_off(sums, min_seeds)
        if not last:
            doubt = F.when(F.col("confidence") >= HEARD, F.log(1 - F.least("confidence", F.lit(0.999999)))).otherwise(F.lit(0.0))
            heard = attach(edges.filter("own").select("pattern", "instance"), patterns.select("pattern", "by", doubt.alias("doubt")), "pattern")
            once = heard.groupBy("instance", "by").agg(F.first("doubt").alias("doubt"))
            told = once.groupBy("instance").agg(F.round(1 - F.exp(F.sum("doubt")), 6).alias("told"))
            strings = edges.groupBy("instance").agg(F.max("seed").alias("seed")).join(told, "instance", "left")
            told = F.coalesce("told", F.lit(0.0))
            scores = strings.select("instance", F.when(F.col("seed") | (told >= known), F.lit(1.0)).otherwise(told).alias("score")).checkpoint()
    return stored(patterns.filter(F.col("confidence") >= min_confidence).select("pattern", "confidence"), "pii-patterns")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``doc_id, base, found`` for every document; ``found`` adds ``context`` spans. Both by kind, then start."""
    rows = occurrences(docs, id_col, text_col)
    seen = rows.select("nth", F.explode("seen").alias("s")).select("nth", "s.*").checkpoint()
    patterns = trusted_patterns(seen.select("pattern", "instance", "seed"), **limits)
    named = attach(seen.filter("NOT seed").select("nth", "pattern", "start", "end").checkpoint(), patterns, "pattern")
    extra = named.groupBy("nth").agg(F.array_sort(F.collect_set(F.struct(F.lit(4).alias("order"), "start", F.lit("context").alias("kind"), "end"))).alias("extra"))
    both = rows.select("doc_id", "nth", "base").join(extra, "nth", "left")
    return both.select("doc_id", "base", F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.concat("base", "extra")).alias("found"))


def personal_data_digest(found: DataFrame) -> DataFrame:
    counts = [count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("found")).alias("spans"))
