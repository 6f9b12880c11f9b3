"""Broadcast only behind a checked size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BROADCAST_BYTES = 64 << 20  # of the rows as they are held by each executor
_ROW_BYTES, _VALUE_BYTES = 32, 8


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its rows take at most ``max_bytes`` (summed by one job),
    else ``df`` unchanged so the planner shuffles both sides."""
    return F.broadcast(df) if fits(df, max_bytes) else df


def fits(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the rows of ``df`` (strings and numbers) take at most ``max_bytes``:
    long strings count by their bytes, so few rows can be too large (one job)."""
    named = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return int(named.agg(F.sum(row_bytes(named))).first()[0] or 0) <= max_bytes


def row_bytes(df: DataFrame) -> Column:
    """The bytes a row of ``df`` (distinct column names) counts for."""
    size = F.lit(_ROW_BYTES + _VALUE_BYTES * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
    return size.cast("long")
