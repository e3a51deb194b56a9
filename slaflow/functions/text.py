"""Text expressions: whitespace trimming, blank tests, full-match patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (Unicode
# whitespace).  Spark's ``trim`` removes only U+0020, so the set is spelled
# out and passed to ``btrim``, which stays a JVM-side, codegen'd expression.
UNICODE_WHITESPACE = "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def text(col: str | Column) -> Column:
    """Raw text with NULL read as the empty string (the source never has NULLs)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def trimmed(col: str | Column) -> Column:
    return F.btrim(text(col), F.lit(UNICODE_WHITESPACE))


def full_match(col: Column, pattern: str) -> Column:
    """Whole-string regex match.

    ``^...$`` in the contract is re-anchored with ``\\A``/``\\z`` so a trailing
    newline cannot satisfy ``$``; ``\\d`` is narrowed to ASCII digits.
    """
    body = pattern
    if body.startswith("^"):
        body = body[1:]
    if body.endswith("$"):
        body = body[:-1]
    body = body.replace(r"\d", "[0-9]")
    return col.rlike(r"\A(?:" + body + r")\z")
