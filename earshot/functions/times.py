"""Wall-clock time helpers. None of them depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.schemas import HOME_TIMEZONE


def from_wall_seconds(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def local_time(instant: Column, tz: str = HOME_TIMEZONE) -> Column:
    """Instant (TIMESTAMP) to whole-second local wall-clock time (TIMESTAMP_NTZ).

    Fractions round half up, as a DATETIME column without fractions stores them.
    """
    shifted = F.unix_micros(F.from_utc_timestamp(instant, tz))
    return from_wall_seconds(F.floor((shifted + 500_000) / 1_000_000))


def wall_seconds(local: Column) -> Column:
    """Wall-clock time (TIMESTAMP_NTZ) as a whole number of seconds.

    The difference of two is the time between them on the clock, also where the clock
    changes. Applied to NTZ the function reads the value as it stands.
    """
    return F.unix_timestamp(local)


def instant(text: Column) -> Column:
    """Time text to an instant, NULL where it is none; text without a zone is UTC."""
    zoned = text.rlike(r"(?:[A-Za-z\]]|:\d{2}(?:\.\d+)?\s?[+-]\d{1,2}(?::?\d{2})?)\s*$")
    utc = [F.try_to_timestamp(F.concat(F.rtrim(text), F.lit(end))) for end in ("Z", "T00:00:00Z")]
    # Exports end in Z: those rows are parsed once, without a pattern.
    plain = text.endswith("Z")
    return F.when(plain | zoned, F.try_to_timestamp(text)).otherwise(F.coalesce(*utc))


def month_of(local: Column) -> Column:
    """``YYYY-MM`` of a wall-clock time."""
    return F.substring(F.to_date(local).cast("string"), 1, 7)
