"""Deterministic hash buckets for sampling and splitting.

The hash is the number in the first 8 hex digits of ``md5(salt || key)``; a sample keeps
the rows whose hash is below ``fraction * 2^32``. A row's hash depends on its key alone,
never on partitioning or task order, and SQL engines with an ``md5`` function compute
the same number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.functions.text import col_of

RANGE = 1 << 32


def hash_number(key, salt: str) -> Column:
    """0 to 2^32 - 1."""
    digest = F.md5(F.concat(F.lit(salt), col_of(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def threshold(fraction: float) -> int:
    """The smallest hash that a sample of ``fraction`` leaves out."""
    return round(fraction * RANGE)


def in_sample(key, fraction: float, salt: str) -> Column:
    """True for about ``fraction`` of keys (resolution 1 / 2^32)."""
    return hash_number(key, salt) < F.lit(threshold(fraction))
