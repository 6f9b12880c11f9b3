"""A3, A4, A5: document frequency and inverse document frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def doc_frequency(entries: DataFrame) -> DataFrame:
    """A3: stored entries per feature, ``(fidx, df)`` with ``fidx = fid - 1``.

    Explicit zero values count too. Partial aggregation runs before the shuffle on
    ``fidx``, so a feature present in most documents is combined per partition.
    """
    return entries.groupBy((F.col("fid") - 1).alias("fidx")).agg(F.count(F.lit(1)).alias("df"))


def idf(entries: DataFrame, docs: DataFrame) -> DataFrame:
    """A4: ``(fidx, df, idf)`` with ``idf = ln(N / df)``, N = rows of ``docs`` (all
    documents, empty ones included). No smoothing. N is a scalar subquery."""
    n = docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    return doc_frequency(entries).select("fidx", "df", F.ln(n / F.col("df")).alias("idf"))
