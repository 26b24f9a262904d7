"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.schemas import TRACK_ID_PATTERN


# The characters that count as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` alone knows spaces only)."""
    return F.btrim(value, F.lit(WHITESPACE))


def present(uri: Column) -> Column:
    """Not NULL and not empty."""
    return uri.isNotNull() & (uri != "")


def track_id(uri: Column) -> Column:
    """Track id of a track URI or track link, NULL where the text is neither."""
    found = F.regexp_extract(uri, TRACK_ID_PATTERN, 1)
    return F.when(found != "", found)


def shown(value: Column, width: int | None = None) -> Column:
    """Report text: NULL shown as empty; cut to ``width`` characters only for printing."""
    text = F.coalesce(value, F.lit(""))
    return text if width is None else F.substring(text, 1, width)
