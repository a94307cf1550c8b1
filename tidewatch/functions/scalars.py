"""Column functions shared by the operators. All of them are built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank of each severity; anything else, "debug" included, ranks 0.
SEVERITY_RANK = {"info": 0, "warn": 1, "warning": 1, "error": 2, "critical": 3}

# Accepted spellings of an approver's decision.
DECISIONS = {
    "APPROVE": "APPROVE",
    "APPROVED": "APPROVE",
    "YES": "APPROVE",
    "Y": "APPROVE",
    "DENY": "DENY",
    "DENIED": "DENY",
    "REJECT": "DENY",
    "REJECTED": "DENY",
    "NO": "DENY",
    "N": "DENY",
}


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_default(c: Column | str, default: str) -> Column:
    """Null and empty text both give the default."""
    return F.coalesce(F.nullif(as_col(c), F.lit("")), F.lit(default))


def num_default(c: Column | str) -> Column:
    """A missing number counts as 0.0."""
    return F.coalesce(as_col(c).cast("double"), F.lit(0.0))


def sql_literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def lookup(c: Column | str, table: Mapping[str, object], default: object = None) -> Column:
    """Value of ``c`` in a small constant table.

    A map literal reads ``c`` once. A CASE would repeat it in every branch, and Catalyst would copy whatever ``c``
    is made of, such as a JSON parse, as often into each filter it pushes down.
    """
    entries = ", ".join(sql_literal(x) for pair in table.items() for x in pair)
    return F.coalesce(F.try_element_at(F.expr(f"map({entries})"), as_col(c)), F.lit(default))


def severity_rank(c: Column | str) -> Column:
    return lookup(F.lower(as_col(c)), SEVERITY_RANK, 0)


def strip(c: Column | str) -> Column:
    """Trim all ASCII white space, not just blanks."""
    return F.btrim(as_col(c), F.lit(" \t\n\r\x0b\x0c"))


def normalize_decision(c: Column | str) -> Column:
    """APPROVE, DENY, or null for a malformed decision."""
    return lookup(F.upper(strip(c)), DECISIONS)


def round_exact(c: Column | str, digits: int) -> Column:
    """Round a double by its exact binary value, ties to even, as IEEE-correct decimal rounding does.

    Built-in ``round`` works on the shortest decimal text instead and so differs on values such as 2.675.
    The product with 10^digits is formed with its rounding error (Dekker's product; the power has few
    enough bits to need no split), and the error decides the cases that look like ties. Up to 7 digits.
    """
    x, scale = as_col(c), F.lit(float(10**digits))
    spread = x * 134217729.0
    high = spread - (spread - x)
    product = x * scale
    error = (high * scale - product) + (x - high) * scale
    whole = F.floor(product).cast("double")
    over = (product - whole - 0.5) + error
    up = (over > 0) | ((over == 0) & (whole % 2 != 0))
    # From 2^52 on a double has no fraction left to round.
    return F.when(F.abs(product) >= float(1 << 52), x).otherwise(F.when(up, whole + 1).otherwise(whole) / scale)


def safe_ratio(a: Column | str, b: Column | str, digits: int = 4) -> Column:
    """Rounded a / b, or 0 where b is not positive."""
    a, b = as_col(a), as_col(b)
    return F.when(b > 0, round_exact(F.try_divide(a, b), digits)).otherwise(F.lit(0.0))


def regex_escape(text: str) -> str:
    """The text as a pattern that matches it literally."""
    return "".join(ch if ch.isalnum() or ch in "_ " else "\\" + ch for ch in text)


def glob_regex(pattern: str) -> str:
    """Anchored regular expression for a shell-style pattern: ``*``, ``?``, ``[seq]`` and ``[!seq]``."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        # A "]" directly after "[" or "[!" belongs to the set, so the closing one is searched behind it.
        body_at = i + 2 if pattern[i + 1 : i + 2] == "!" else i + 1
        end = pattern.find("]", body_at + 1) if ch == "[" else -1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif end > 0:
            body = pattern[body_at:end]
            for special in ("\\", "[", "]", "^", "&"):
                body = body.replace(special, "\\" + special)
            out.append(("[^" if body_at == i + 2 else "[") + body + "]")
            i = end
        else:
            out.append(regex_escape(ch))
        i += 1
    return r"(?s)\A" + "".join(out) + r"\z"


def glob_match(c: Column | str, pattern: str) -> Column:
    if pattern == "*":
        return as_col(c).isNotNull()
    return as_col(c).rlike(glob_regex(pattern))


def glob_match_column(c: Column | str, pattern: Column | str, regex: Column | str) -> Column:
    """Glob test where each rule row brings its own pattern and the regex made from it."""
    c, pattern, regex = as_col(c), as_col(pattern), as_col(regex)
    return pattern.isin("*", "") | F.rlike(c, regex)


def render_target(template: Column | str, service: Column | str) -> Column:
    """Fill ``{service}``; a template with any other brace falls back to the service itself."""
    template, service = as_col(template), as_col(service)
    rest = F.replace(template, F.lit("{service}"), F.lit(""))
    rendered = F.replace(template, F.lit("{service}"), service)
    broken = rest.contains("{") | rest.contains("}")
    return F.when(broken, service).otherwise(rendered)


def canonical_json(fields: Mapping[str, Column | str], raw: tuple[str, ...] = ()) -> Column:
    """JSON object with sorted keys and no blanks; null stays null. Fields named in ``raw`` already hold JSON text."""
    parts: list[Column] = []
    plain: list[Column] = []

    def flush() -> None:
        if plain:
            text = F.to_json(F.struct(*plain), {"ignoreNullFields": "false"})
            parts.append(F.substr(text, F.lit(2), F.length(text) - F.lit(2)))
            plain.clear()

    for name in sorted(fields):
        col = as_col(fields[name])
        if name in raw:
            flush()
            parts.append(F.concat(F.lit(f'"{name}":'), F.coalesce(col, F.lit("null"))))
        else:
            plain.append(col.alias(name))
    flush()
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def stable_id(canonical: Column | str) -> Column:
    """First 24 hex digits of the SHA-256 of a canonical JSON text."""
    return F.substring(F.sha2(as_col(canonical), 256), 1, 24)


def parse_ts(c: Column | str) -> Column:
    """Timestamp from ISO text (``Z`` or offset), epoch milliseconds (12 digits and up) or epoch seconds."""
    text = F.trim(as_col(c).cast("string"))
    digits = text.rlike(r"\A[0-9]+\z")
    number = F.when(digits, text.try_cast("bigint"))
    return (
        F.when(digits & (F.length(text) >= 12), F.timestamp_millis(number))
        .when(digits, F.timestamp_seconds(number))
        .otherwise(F.try_to_timestamp(text))
    )


def iso_z(c: Column | str) -> Column:
    """ISO text in UTC with second precision; the session time zone must be UTC."""
    return F.date_format(as_col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def micros(c: Column | str) -> Column:
    return F.unix_micros(as_col(c).cast("timestamp"))


def micros_to_ts(c: Column | str) -> Column:
    return F.timestamp_micros(as_col(c))
