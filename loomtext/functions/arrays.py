"""Exploding arrays without an inferred scan-side filter.

For ``explode`` the optimizer adds ``size(array) > 0`` and pushes it below the
projections that build the array, substituting the whole array expression into a
filter near the scan: the array is then built twice, and an expression staged through
columns for lambda functions is inlined back into the lambdas. ``explode_outer``
followed by a null filter above the generator keeps one evaluation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, array: Column, alias: str, keep=()) -> DataFrame:
    """``select(*keep, explode(array) as alias)``; rows with empty arrays vanish."""
    return df.select(*keep, F.explode_outer(array).alias(alias)).where(F.col(alias).isNotNull())


def posexplode_rows(df: DataFrame, array: Column, pos: str, alias: str, keep=()) -> DataFrame:
    """``posexplode`` counterpart of :func:`explode_rows`."""
    return df.select(*keep, F.posexplode_outer(array).alias(pos, alias)).where(F.col(pos).isNotNull())


def repeat_rows(df: DataFrame, times: str, out: str, step: int = 1 << 16) -> DataFrame:
    """Each row as often as ``times`` (a positive count) says, numbered 1.. in ``out``: two
    explodes of at most ``step`` numbers at a time for up to step^2 copies, so a row that
    stands for a third of a table is never one array of that length."""
    runs = df.withColumn("_run", F.explode(F.expr(f"sequence(0L, (`{times}` - 1) div {step})")))
    numbers = F.expr(f"sequence(_run * {step} + 1, least((_run + 1) * {step}, `{times}`))")
    return runs.withColumn(out, F.explode(numbers)).drop("_run")
