"""Parquet tables by name under one folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
SCAN_PARTITIONS = "spark.loomtext.scanPartitions"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``<folder>/<name>.parquet``; column pruning and filters reach the scan."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` into ``spark.loomtext.scanPartitions`` parts; unset (the
    default) leaves the scan alone. A setting for small inputs that lie in one row group,
    whose CPU-heavy rows one task would otherwise work through; a large input has
    splits enough."""
    parts = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(parts), key) if parts else df
