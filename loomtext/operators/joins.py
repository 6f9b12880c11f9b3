"""key/value rows joined to a key set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_join(kv: DataFrame, keys: DataFrame, key: str = "key", semi: bool = False) -> DataFrame:
    """Inner join of ``(key, value)`` rows to a key column.

    A key listed n times multiplies its rows n times (an inner join, as specified);
    ``semi=True`` keeps each row once (``left_semi``). Keys are counted first (a partial
    aggregate), so a key listed often meets its rows as one row and is multiplied after
    the join, row by row; a key with many rows is then hot on one side only, which AQE
    can split.
    """
    if semi:
        return kv.join(keys.select(key), key, "left_semi")
    counted = keys.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    met = kv.join(counted, key)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))
    return met.withColumn("_n", times).drop("_n")
