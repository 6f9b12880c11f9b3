"""Helpers shared by the operators: graph components, running offsets, stored stages."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtext.session import reliable_checkpoint
from loomtext.sources.tables import table

WORD = r"[^\x20\x09-\x0D]+"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a stage table into the shared checkpoint folder and read it back."""
    return reliable_checkpoint(df, f"llm-{name}")


def columns_of(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of one input table."""
    return table(spark, sf_dir, name).select(*cols)


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node reachable) that connect what the edges u-v connect."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, before[a], least)
        np.minimum.at(label, before[b], least)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    kept = label != np.arange(len(nodes))
    return nodes[kept], nodes[label[kept]]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (u, v), component being
    the smallest node reachable. Alternating large-star / small-star rounds; each round
    is stored in the shared folder, so a lost executor costs one round at most. Hub
    nodes meet a one-row minimum in a join (which AQE may split), never in a group.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()
    e = store(e, "edges")
    seen = _signature(e)
    while seen[0]:
        both = e.select(F.col("a").alias("x"), F.col("b").alias("y")).union(e.select("b", "a"))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("a"), F.col("m").alias("b"))
        large = store(large.where("a <> b").distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = store(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        now = _signature(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _signature(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def running_offsets(df: DataFrame, group: list[str], order: list[Column], spread_on: Column, weight: Column,
                    buckets: int, name: str = "offset") -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows of the same group that stand
    before a row, in the order (bucket of ``spread_on``, ``order``).

    A group of any size is cut into ``buckets`` hash buckets: one window runs inside
    each (group, bucket), and the bucket totals (groups x buckets rows) get their own
    running sum per group. ``order`` must be total up to equal rows.
    """
    dealt = df.withColumn("_bucket", F.pmod(spread_on, F.lit(buckets))).withColumn("_weight", weight.cast("long"))
    before = (Window.unboundedPreceding, -1)
    # a last, even key keeps a window over few groups from meeting in one task
    totals = dealt.groupBy(*group, "_bucket").agg(F.sum("_weight").alias("_sum"))
    w = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(*before)
    bases = totals.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_bucket").alias("_b"),
                          F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_base"))
    w = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(*before)
    inside = dealt.withColumn("_inside", F.coalesce(F.sum("_weight").over(w), F.lit(0)))
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group] + [F.col("_bucket") == F.col("_b")]
    on = same[0]
    for c in same[1:]:
        on = on & c
    out = inside.join(bases, on)
    return out.withColumn(name, F.col("_inside") + F.col("_base")).drop(
        "_bucket", "_weight", "_inside", "_base", "_b", *[f"_g_{g}" for g in group])
