"""Day boundaries and 30-day activity bitmaps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.functions.text import col_of

MAX_DAY = 30


def day_to_bit(day) -> Column:
    """``1 << (day - 1)``; a day outside 1..30 fails the query."""
    d = col_of(day)
    return F.when((d >= 1) & (d <= MAX_DAY), F.call_function("shiftleft", F.lit(1), d - 1)).otherwise(
        F.raise_error(F.concat(F.lit("day out of range 1..30: "), d.cast("string"))))


def bits_to_days(bits) -> Column:
    """Number of active days in a bitmap."""
    return F.bit_count(col_of(bits)).cast("int")


def day_boundary_ms(ts, days_before: int) -> Column:
    """U8: epoch milliseconds of midnight (session time zone) ``days_before`` days
    before the day of ``ts``."""
    day = F.date_sub(F.to_date(col_of(ts)), days_before)
    return F.unix_millis(F.to_timestamp(day))
