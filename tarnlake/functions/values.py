"""Typed readings of raw text: casts, dates, safe ratios."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strptime directives and the datetime pattern letters they stand for.
_DATE_DIRECTIVES = {
    "Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss", "z": "xx",
    "y": "yy", "j": "DDD", "b": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "I": "hh", "p": "a",
}

TRUE_WORDS = ("true", "1", "yes")

# Layouts a survivorship timestamp may have, most specific first.
RECENCY_LAYOUTS = ("%Y-%m-%dT%H:%M:%S.%fZ", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d")


def date_pattern(directives: str, parsing: bool = False) -> str:
    """Spark datetime pattern for a strptime/strftime layout.

    ``%f`` takes one to six digits when parsing and writes six when formatting.
    """
    out: list[str] = []
    literal = ""
    i = 0

    def flush() -> None:
        nonlocal literal
        if literal:
            out.append("'" + literal.replace("'", "''") + "'")
            literal = ""

    while i < len(directives):
        ch = directives[i]
        if ch != "%":
            if ch.isalpha() or ch in "'[]{}#":
                literal += ch
            else:
                flush()
                out.append(ch)
            i += 1
            continue
        code = directives[i + 1]
        flush()
        i += 2
        if code == "%":
            out.append("%")
        elif code == "f":
            if parsing and out and out[-1] == ".":
                out.pop()
                out.append("".join(f"[.{'S' * n}]" for n in range(6, 0, -1)))
            else:
                out.append("SSSSSS")
        elif code in _DATE_DIRECTIVES:
            out.append(_DATE_DIRECTIVES[code])
        else:
            raise ValueError(f"date directive %{code} is not supported")
    flush()
    return "".join(out)


def parse_layout(value: Column, directives: str) -> Column:
    """Timestamp read with one layout; null when the text does not have it."""
    return F.try_to_timestamp(value, F.lit(date_pattern(directives, parsing=True)))


def parse_recency(value: Column) -> Column:
    """Timestamp from any of the three ISO layouts, else null."""
    text = value.cast("string")
    return F.coalesce(*[parse_layout(text, layout) for layout in RECENCY_LAYOUTS])


def parse_iso_date(value: Column) -> Column:
    """Date of an ISO date or date-time text, with or without zone; else null."""
    text = F.trim(value.cast("string"))
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{3}(\d{3})?)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    return F.when(iso, F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")).cast("date"))


def is_missing(column: Column) -> Column:
    """Null or empty text."""
    return column.isNull() | (column.cast("string") == "")


def truthy_text(column: Column) -> Column:
    return F.lower(column.cast("string")).isin(*TRUE_WORDS)


def cast_to(column: Column, target: str, strict: bool = True) -> Column:
    """Cast by type name; strict raises on bad text (ANSI), otherwise bad text becomes null."""
    text = column
    if target == "string":
        return text.cast("string")
    if target == "integer":
        trimmed = F.trim(text.cast("string"))
        return trimmed.cast("long") if strict else trimmed.try_cast("long")
    if target in ("decimal", "float"):
        trimmed = F.trim(text.cast("string"))
        return trimmed.cast("double") if strict else trimmed.try_cast("double")
    if target == "boolean":
        return truthy_text(text)
    return text


def keep_last(column: Column, visible: int) -> Column:
    """Stars with the last ``visible`` characters left readable; short text is all stars."""
    text = column.cast("string")
    length = F.length(text)
    hidden = F.when(length <= visible, length).otherwise(length - visible)
    return F.concat(
        F.repeat(F.lit("*"), hidden),
        F.when(length <= visible, F.lit("")).otherwise(F.right(text, F.lit(visible))),
    )


def redact_key(column: Column) -> Column:
    """First two and last two characters readable; four or fewer are all stars."""
    text = column.cast("string")
    length = F.length(text)
    return F.when(length <= 4, F.repeat(F.lit("*"), length)).otherwise(
        F.concat(F.substring(text, 1, 2), F.repeat(F.lit("*"), length - 4), F.right(text, F.lit(2)))
    )


def variance_pct(expected: Column, observed: Column) -> Column:
    """Distance from the expected value in percent; 100 when only the expected value is zero."""
    e, o = expected.cast("double"), observed.cast("double")
    return F.when(expected == 0, F.when(observed == 0, F.lit(0.0)).otherwise(F.lit(100.0))).otherwise(
        F.abs(o - e) / F.abs(e) * 100.0
    )


def rate_pct(part: Column, whole: Column, empty: float) -> Column:
    """100 * part / whole, or ``empty`` without rows."""
    return F.when(whole == 0, F.lit(empty)).otherwise(
        F.lit(100.0) * part.cast("double") / whole.cast("double")
    )


@F.pandas_udf(T.StringType())
def two_places(values: pd.Series) -> pd.Series:
    """Two decimals, rounded on the exact binary value.

    The JVM formatter rounds the shortest decimal text instead, which differs at ties. For result
    rows of a report, not for data rows.
    """
    return values.map(lambda v: None if pd.isna(v) else f"{v:.2f}")
