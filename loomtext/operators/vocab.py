"""A2, F5, O1 (vocabulary) and F3, P6, J5, A10 (category dictionary)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.operators.ids import dense_ids
from loomtext.operators.sizing import broadcast_if_small
from loomtext.session import reliable_checkpoint

MIN_COUNT = 31  # a feature needs strictly more than 30 occurrences


def feature_frequency(instances: DataFrame, feature: str = "feature") -> DataFrame:
    """A2: occurrences of each feature over all instance rows (values ignored)."""
    return instances.groupBy(feature).agg(F.count(F.lit(1)).alias("cnt"))


def vocabulary(instances: DataFrame, min_count: int = MIN_COUNT, feature: str = "feature") -> DataFrame:
    """A2 + F5 + O1: ``(feature, fid, cnt)`` for features seen at least ``min_count``
    times, ``fid`` = 1.. by descending count, then feature text."""
    return numbered_features(feature_frequency(instances, feature).withColumnRenamed(feature, "feature"), min_count)


def numbered_features(freq: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """F5 + O1 of ``(feature, cnt)``."""
    kept = freq.where(F.col("cnt") >= min_count)
    voc = dense_ids(kept, [F.col("cnt").desc(), F.col("feature").asc()], id_col="fid", start=1)
    return voc.select("feature", "fid", "cnt")


def category_dictionary(labels: DataFrame, label: str) -> DataFrame:
    """Category names -> ids ``0..C-1`` in name order: ``(name, category_id)``. Categories
    are classes of a model, a list that one task holds."""
    names = labels.select(F.col(label).alias("name")).where(F.col("name").isNotNull()).distinct()
    names = reliable_checkpoint(names, "category-names")
    return dense_ids(names, [F.col("name").asc()], id_col="category_id", start=0, bounded=True) \
        .select("name", F.col("category_id").cast("int"))


def with_category_id(df: DataFrame, dictionary: DataFrame, label: str) -> DataFrame:
    """F3 + P6 + J5: keep rows whose label is a dictionary name and add its id (one
    equi-join; the dictionary is broadcast behind a check of its bytes, so a hot category
    moves no documents)."""
    return df.join(broadcast_if_small(dictionary.withColumnRenamed("name", label)), label)


def class_count(dictionary: DataFrame) -> DataFrame:
    """A10: largest category id + 1."""
    return dictionary.agg((F.max("category_id") + 1).alias("num_classes"))
