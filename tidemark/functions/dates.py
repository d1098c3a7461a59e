"""Date/time expressions (D1-D7, T13). Session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ts(c) -> Column:
    """Epoch seconds -> timestamp (UTC)."""
    return F.timestamp_seconds(_col(c))


def parse_ts(c, fmt: str | None = None) -> Column:
    """Parse text to a timestamp with a format; text that does not
    parse gives null (never an error, also under ANSI mode)."""
    if fmt is None:
        return F.try_to_timestamp(_col(c))
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def floor_hour(c) -> Column:
    """D4."""
    return F.date_trunc("hour", _col(c))


def day_windows(start, end, window_days: int = 1, step_days: int = 1) -> Column:
    """Array of (win_start, win_end) date windows from ``start`` to ``end``
    (inclusive), ``window_days`` long, every ``step_days`` days."""
    starts = F.sequence(_col(start), _col(end), F.expr(f"INTERVAL {int(step_days)} DAY"))
    return F.transform(starts, lambda d: F.struct(
        d.alias("win_start"), F.date_add(d, int(window_days)).alias("win_end")))
