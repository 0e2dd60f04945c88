"""Text canonicalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character that Python's str.strip() removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim all Unicode white space; NULL becomes the empty string.

    ``trim`` alone removes only U+0020, and ``\\s`` misses U+001C to U+001F.
    """
    return F.coalesce(F.btrim(c, F.lit(WHITE_SPACE)), F.lit(""))


def is_missing(c: Column) -> Column:
    return strip(c) == ""


def canonical_code(c: Column) -> Column:
    """Trimmed and upper-cased code, e.g. a currency."""
    return F.upper(strip(c))
