"""Timestamp expressions.  The session time zone is UTC (see ``session``)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from slaflow.contract import java_timestamp_pattern

MICROS_PER_MINUTE = 60_000_000


#: What each directive takes, first alternative first: one digit or two, a
#: day also with a blank before it, seconds up to 61 (they run over into the
#: next minute).
_DIRECTIVES = {
    "Y": r"(\d\d\d\d)",
    "m": r"(1[0-2]|0[1-9]|[1-9])",
    "d": r"(3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9])",
    "H": r"(2[0-3]|[0-1]\d|\d)",
    "M": r"([0-5]\d|\d)",
    "S": r"(6[0-1]|[0-5]\d|\d)",
}
#: The whole seconds that fit into 64 bits of nanoseconds.
FIRST, LAST = "1677-09-21 00:12:44", "2262-04-11 23:47:16"


def _directives(strftime_format: str) -> tuple[str, list[str]]:
    """Regular expression of a format and the directives in its order."""
    parts, order = [], []
    for literal, code in re.findall(r"([^%]*)(?:%(.)|$)", strftime_format):
        parts.append(re.escape(literal))
        if code:
            parts.append(_DIRECTIVES[code])
            order.append(code)
    return f"(?i)^{''.join(parts)}\\z", order


def any_timestamp(text_col: Column, strftime_format: str) -> Column:
    """``parse_timestamp`` without its limits (``in_range``).  Texts with all
    digits in place, nearly all of them, are parsed at once; the others are
    taken apart."""
    strict = F.try_to_timestamp(text_col, F.lit(java_timestamp_pattern(strftime_format)))
    pattern, order = _directives(strftime_format)
    part = {c: F.trim(F.regexp_extract(text_col, pattern, i + 1)).try_cast("int") for i, c in enumerate(order)}
    of = lambda c, default: part.get(c, F.lit(default))
    minute = F.try_make_timestamp(of("Y", 1900), of("m", 1), of("d", 1), of("H", 0), of("M", 0), F.lit(0).cast("decimal(16,6)"))
    loose = F.timestamp_micros(F.unix_micros(minute) + of("S", 0).cast("long") * F.lit(1_000_000))
    return F.coalesce(strict, loose)


def in_range(parsed: Column) -> Column:
    """The timestamp, NULL where 64 bits of nanoseconds can't hold it.  Refers
    to it three times: give it a column, not the expression that parses."""
    return F.when(parsed.between(F.lit(FIRST).cast("timestamp"), F.lit(LAST).cast("timestamp")), parsed)


def parse_timestamp(text_col: Column, strftime_format: str) -> Column:
    """The UTC timestamp of a text in the format, NULL when it doesn't fit.
    Letters match in either case, numbers may lack their leading zero, and
    times that 64 bits of nanoseconds can't hold don't fit."""
    return in_range(any_timestamp(text_col, strftime_format))


def micros_to_minutes(micros: Column) -> Column:
    """Fractional minutes of a microsecond duration (seconds first, then /60)."""
    return (micros.cast("double") / F.lit(1_000_000.0)) / F.lit(60.0)


def add_minutes_micros(start_micros: Column, minutes: Column) -> Column:
    """start + a whole number of minutes, in epoch microseconds."""
    return start_micros + minutes.cast("long") * F.lit(MICROS_PER_MINUTE)


def fraction_micros(start_micros: Column, duration_micros: Column, percent: Column | int) -> Column:
    """start + percent % of the duration, exact integer arithmetic in
    microseconds (durations are non-negative)."""
    pct = percent if isinstance(percent, Column) else F.lit(percent)
    return start_micros + F.call_function("div", duration_micros * pct, F.lit(100))


def date_key(ts: Column) -> Column:
    """yyyyMMdd integer key of the UTC calendar day."""
    return F.date_format(ts, "yyyyMMdd").cast("int")


def calendar_columns(day: Column) -> list[Column]:
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_of_week"),
    ]
