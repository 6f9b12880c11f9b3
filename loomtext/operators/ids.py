"""O1: dense, ordered ids (1..n) without a single-partition exchange.

``row_number()`` over an unpartitioned window moves every row into one task. Here the
rows are range-partitioned on the sort key and sorted inside each partition; each row's
range index and position inside its range are written with it to the shared
checkpoint folder, so the sampled boundaries cannot change between the two passes
that follow: one counts rows per range (one row per range), the other adds the
broadcast per-range offsets (as many rows as ranges) to the local positions.

A caller that knows a bound of the rows (a category list) states it with
``bounded=True``; one ordered window numbers those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.session import reliable_checkpoint

_SHIFT = 33  # monotonically_increasing_id = partition index << 33 | row index


def dense_ids(df: DataFrame, order: list[Column | str], id_col: str = "id", start: int = 1,
              bounded: bool = False) -> DataFrame:
    """Number the rows of ``df`` ``start, start+1, ...`` in ``order`` (must be a total
    order for repeatable ids). ``bounded``: the caller knows that one task can hold them."""
    if bounded:
        w = Window.orderBy(*order)
        return df.withColumn(id_col, (F.row_number().over(w) - 1 + F.lit(start)).cast("long"))
    # The range partitioner samples its input in a job of its own: number a stored
    # copy so the (possibly expensive) input is computed once, not twice. The number of
    # ranges is left to the session and to AQE, which joins small ones.
    stored = reliable_checkpoint(df, "dense-ids-input")
    ordered = stored.repartitionByRange(*order).sortWithinPartitions(*order)
    # Range index and position inside the range, written with the rows in one job.
    local = (ordered.withColumn("_pid", F.spark_partition_id())
             .withColumn("_local", F.monotonically_increasing_id()))
    local = local.withColumn("_local", F.col("_local") - F.shiftleft(F.col("_pid").cast("long"), _SHIFT))
    fixed = reliable_checkpoint(local, "dense-ids")
    counts = fixed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = fixed.join(F.broadcast(offsets), "_pid")
    return out.withColumn(id_col, (F.col("_off") + F.col("_local") + F.lit(start)).cast("long")) \
        .drop("_pid", "_local", "_off")
