"""Play quality, percentage and skip flag as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.schemas import FULL_LISTEN, NATURAL_END, PARTIAL, SKIP, STOP_REASONS, Thresholds

UNKNOWN = "unknown"


def share(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as DECIMAL(5,4), NULL for a zero denominator.

    The quotient of two integers is either a decimal tie, which prints exactly, or far
    enough from one for a double to fall on the right side, so the cast rounds half up.
    """
    return F.when(denominator != 0, numerator / denominator).cast("decimal(5,4)")


def played_share(ratio: Column) -> Column:
    """Stored percentage: capped at 1, NULL for a NULL ratio (``least`` alone skips NULL)."""
    return F.when(ratio.isNotNull(), F.least(ratio, F.lit(1.0))).cast("decimal(5,4)")


def low_confidence(ms_played: Column, reason_start: Column, reason_end: Column) -> Column:
    """Zero milliseconds with neither a start nor an end signal; NULL for NULL ms_played."""

    def silent(reason: Column) -> Column:
        return reason.isNull() | (reason == UNKNOWN)

    return (ms_played == 0) & silent(reason_end) & silent(reason_start)


def _by_ratio(ratio: Column, limits: Thresholds) -> Column:
    return (
        F.when(ratio >= limits.full_listen, FULL_LISTEN)
        .when(ratio < limits.skip, SKIP)
        .when(ratio.isNotNull(), PARTIAL)
    )


def history_ratio(ms_played: Column, duration_ms: Column) -> Column:
    return F.when(duration_ms > 0, ms_played / duration_ms)


def history_quality(reason_end: Column, ratio: Column, limits: Thresholds) -> Column:
    """The end reason decides where it is clear, the played ratio elsewhere."""
    by_reason = (
        F.when(reason_end == "trackdone", FULL_LISTEN)
        .when(reason_end == "fwdbtn", SKIP)
        .when(reason_end.isin(*STOP_REASONS), NATURAL_END)
    )
    replay = F.when(
        reason_end == "backbtn",
        F.when(ratio < limits.back_button, SKIP).when(ratio.isNotNull(), FULL_LISTEN),
    )
    return F.coalesce(by_reason, replay, _by_ratio(ratio, limits), F.lit(PARTIAL))


def recent_ratio(gap_seconds: Column, duration_ms: Column) -> Column:
    return F.when(duration_ms != 0, gap_seconds * 1000.0 / duration_ms)


def recent_quality(gap_seconds: Column, ratio: Column, limits: Thresholds) -> Column:
    """A long gap ends a session; otherwise the gap stands for the time played."""
    session_end = gap_seconds > limits.session_gap_seconds
    return F.when(session_end, NATURAL_END).otherwise(_by_ratio(ratio, limits))


def recent_ms(gap_seconds: Column, duration_ms: Column, quality: Column) -> Column:
    heard = gap_seconds * 1000
    return F.when(quality == FULL_LISTEN, F.least(heard, duration_ms)).when(
        quality.isin(SKIP, PARTIAL), heard
    )


def is_skip(quality: Column) -> Column:
    return quality == SKIP
