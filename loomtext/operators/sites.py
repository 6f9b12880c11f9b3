"""Pages per canonical site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.functions.urls import domain_parts


def site_rollup(pages: DataFrame, url: str = "url") -> DataFrame:
    """``(domain, pages, paths)``: pages per canonical domain (U3, ``""`` for an
    unusable host) and distinct first path segments."""
    parts = pages.select(domain_parts(F.col(url)).alias("d"))
    return parts.groupBy(F.col("d.domain").alias("domain")).agg(
        F.count(F.lit(1)).alias("pages"), F.count_distinct(F.col("d.p1")).alias("paths"))
