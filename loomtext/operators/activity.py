"""Per-user 30-day activity bitmaps and active-day counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.functions.bits import bits_to_days, day_to_bit


def active_days(events: DataFrame, user: str, day: str) -> DataFrame:
    """``(user, bitmap, active_days)``: bit ``d-1`` set when the user was active on day
    ``d`` (1..30). ``bit_or`` is a partial aggregate, so a user with a third of all
    events is folded per partition before the shuffle."""
    return (events.groupBy(user).agg(F.bit_or(day_to_bit(F.col(day))).alias("bitmap"))
            .withColumn("active_days", bits_to_days("bitmap")))
