"""Time expressions (P4, P5, P9, P10, P12). Session zone is UTC (see session.py)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def epoch_to_instant(c) -> Column:
    """Integer epoch seconds -> timestamp: 1786481729 is 2026-08-11T20:55:29Z."""
    return F.timestamp_seconds(as_col(c))


def to_day(c) -> Column:
    """Calendar day of an instant in the session zone (UTC) (P5)."""
    return F.to_date(as_col(c))


def now_literal(now: dt.datetime | None = None) -> Column:
    """Processing time (P9). Pass ``now`` in tests for a fixed value."""
    if now is None:
        return F.current_timestamp()
    return F.lit(now).cast("timestamp")


def is_in_future(c, now: dt.datetime | None = None, slack: str = "1 day") -> Column:
    """``c > now + interval <slack>`` (P10); ``now`` injectable for tests."""
    return as_col(c) > now_literal(now) + F.expr(f"interval {slack}")


def iso_prefix_timestamp(c) -> Column:
    """``s[:19].replace('T', ' ')`` as a timestamp; NULL or empty -> NULL."""
    text = F.regexp_replace(F.substring(as_col(c), 1, 19), "T", " ")
    return F.when(text == F.lit(""), F.lit(None)).otherwise(F.try_to_timestamp(text))
