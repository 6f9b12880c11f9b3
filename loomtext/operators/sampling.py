"""Deterministic hash sampling and splitting, and A6 one record per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.functions.hashing import in_sample

FIRST_SALT, SECOND_SALT, SPLIT_SALT = "s1:", "s2:", "split:"


def hash_sample(df: DataFrame, key: str, fraction: float, salt: str = FIRST_SALT) -> DataFrame:
    """Keep rows whose key hashes into the first ``fraction`` of buckets.

    A narrow filter; the same key is kept or dropped on every run and layout.
    """
    return df.where(in_sample(key, fraction, salt))


def two_stage_sample(df: DataFrame, key: str, first: float, second: float) -> DataFrame:
    """R2: two independent stages; the second uses another salt (the same salt would
    keep every row the first stage kept)."""
    return hash_sample(hash_sample(df, key, first, FIRST_SALT), key, second, SECOND_SALT)


def split_column(key: str, test_fraction: float = 0.3, salt: str = SPLIT_SALT):
    """R3 as a column: ``'test'`` for about ``test_fraction`` of keys, else ``'train'``."""
    return F.when(in_sample(key, test_fraction, salt), F.lit("test")).otherwise(F.lit("train"))


def train_test_split(df: DataFrame, key: str, test_fraction: float = 0.3,
                     salt: str = SPLIT_SALT) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by hash of ``key``."""
    tagged = df.withColumn("_split", split_column(key, test_fraction, salt))
    return (tagged.where(F.col("_split") == "train").drop("_split"),
            tagged.where(F.col("_split") == "test").drop("_split"))


def one_per_key(df: DataFrame, key: str, order: str, keep_null_keys: bool = False) -> DataFrame:
    """One row per ``key``, the row with the smallest ``order`` value. Rows without
    a key form one group, as in the reference; ``keep_null_keys=True`` passes each of
    them through instead.

    ``min`` over a struct led by ``order`` is computed partially before the shuffle,
    so a key shared by a third of all rows is folded per partition first.
    """
    others = [c for c in df.columns if c not in (key, order)]
    cols = [key, order, *others]
    grouped = df.where(F.col(key).isNotNull()) if keep_null_keys else df
    best = grouped.groupBy(key).agg(F.min(F.struct(order, *others)).alias("_best"))
    out = best.select(key, *[F.col(f"_best.{c}").alias(c) for c in [order, *others]])
    if keep_null_keys:
        out = out.unionByName(df.where(F.col(key).isNull()).select(*cols))
    return out


def picked_lines(labelled: DataFrame, fraction: float) -> DataFrame:
    """R2's second stage on labelled log records: a narrow filter on the hash of ``line``,
    so it holds for a batch and a stream alike; equal lines are kept or dropped together."""
    return labelled.where(in_sample(F.xxhash64("line"), fraction, SECOND_SALT))


def one_per_title(labelled: DataFrame) -> DataFrame:
    """A6 on labelled log records: ``(tit, line, tag)``, per title the smallest line, which
    does not depend on files, hours or copies."""
    return one_per_key(labelled.select("tit", "line", "tag"), key="tit", order="line")
