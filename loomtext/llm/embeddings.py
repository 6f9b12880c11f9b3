"""Embedding near-duplicates through a pivot-permutation index.

Every vector is described by its nearest reference points (pivots), nearest first. It
stands in the inverted lists of its first ``LISTED`` pivots; two vectors of a list that
share ``SHARED`` or more of their ``DEPTH`` nearest pivots are candidates, and their
cosine is verified in double precision. A pair is counted in the list of the smallest
pivot that lists both, so links need no pair table. Candidate pairs of a dense list may
be as many as all its pairs, so vectors travel to the lists, once, and pairs never leave
them.

Pivots are Gaussian directions drawn without the data, not sampled rows: the inner
products of two unit vectors with such a direction are normal with their cosine as
correlation, so whether a pair meets depends on its cosine and the number of pivots
alone, not on how dense the table is around it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from loomtext.llm.common import connected_components, forest, store
from loomtext.llm.search import finite, matrix

COSINE = 0.9
PIVOTS_PER_ROOT = 4  # pivots per square root of the number of distinct vectors
MOST_PIVOTS = 16_384  # bound of what each task holds of them, and of the table of list sizes
SEED = 42
DEPTH, LISTED, SHARED = 16, 8, 2
LIST_BLOCK = 1024  # members of a list that one task compares; longer lists are cut


def units(vectors: pd.Series, width: int) -> np.ndarray:
    """Unit vectors in doubles (scaled first, so tiny and huge ones keep their direction)."""
    m = matrix(vectors, width)
    m /= np.maximum(np.abs(m).max(axis=1, keepdims=True, initial=0), 5e-324)
    return m / np.sqrt((m ** 2).sum(axis=1, keepdims=True))


def directions(n: int, width: int, seed: int = SEED) -> np.ndarray:
    """Pivots for ``n`` distinct vectors. Their lengths stay as drawn: with unit lengths
    what a pair shares would depend on the width, too."""
    some = min(MOST_PIVOTS, max(DEPTH, math.ceil(PIVOTS_PER_ROOT * math.sqrt(n))))
    return np.random.default_rng(seed).normal(size=(some, width))


def describe(classes: DataFrame, n: int, width: int, depth: int = DEPTH) -> DataFrame:
    """``classes`` (id, v, n), ``n`` of them, with near: the indexes of the nearest pivots,
    nearest first. Every task draws the pivots itself."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots = directions(n, width)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at: at + 1024]
                close = units(part["v"], width) @ pivots.T
                k = min(depth, close.shape[1])
                near = np.argpartition(-close, k - 1, axis=1)[:, :k]
                by = np.argsort(-np.take_along_axis(close, near, axis=1), axis=1, kind="stable")
                yield part.assign(near=list(np.take_along_axis(near, by, axis=1).astype(np.int16)))

    kind = classes.schema["v"].dataType.simpleString()
    return classes.mapInPandas(run, f"id long, v {kind}, n long, near array<short>")


def link_lists(described: DataFrame, width: int, cosine: float = COSINE, block: int = LIST_BLOCK,
               listed: int = LISTED, shared: int = SHARED) -> DataFrame:
    """(u, v, links): per list, each member's linked rows that this list counts, and an
    edge (u, v) of a forest over the list's links (v null: none)."""
    lists = described.select("id", "v", "n", "near", F.explode(F.slice("near", 1, listed)).alias("pivot"))
    sizes = lists.groupBy("pivot").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # at most MOST_PIVOTS rows of two numbers: a proven bound for the broadcast
    placed = lists.join(F.broadcast(sizes), "pivot").withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    placed = placed.withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = placed.select(F.xxhash64("pivot", F.least("side", "other"), F.greatest("side", "other")).alias("key"),
                          "pivot", "side", (F.col("side") != F.col("other")).alias("cross"), "id", "v", "n", "near")

    def links(group: pd.DataFrame) -> pd.DataFrame:
        unit, ids, n = units(group["v"], width), group["id"].to_numpy(), group["n"].to_numpy()
        near = np.stack(group["near"].to_numpy()).astype(np.int32)
        names, code = np.unique(near, return_inverse=True)
        has = np.zeros((len(group), len(names)), np.float32)
        np.put_along_axis(has, code.reshape(near.shape), 1, axis=1)
        need = min(shared, near.shape[1])
        i, j = np.nonzero(np.triu((has @ has.T >= need), 1))
        if group["cross"].iat[0]:
            side = group["side"].to_numpy()
            kept = side[i] != side[j]
            i, j = i[kept], j[kept]
        found = []
        for at in range(0, len(i), 1 << 18):
            a, b = i[at: at + (1 << 18)], j[at: at + (1 << 18)]
            good = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
            found.append((a[good], b[good]))
        i, j = [np.concatenate(x) for x in zip(*found, strict=True)] if found else (i, j)
        first = np.sort(near[:, :listed], axis=1)  # the smallest pivot that lists both counts the pair
        counts = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 16):
            a, b = first[i[at: at + (1 << 16)]], first[j[at: at + (1 << 16)]]
            both = np.where((a[:, :, None] == b[:, None, :]).any(axis=2), a, np.iinfo(np.int32).max).min(axis=1)
            counts[at: at + (1 << 16)] = both == group["pivot"].iat[0]
        linked = np.bincount(i[counts], n[j[counts]], len(group)) + np.bincount(j[counts], n[i[counts]], len(group))
        some = np.flatnonzero(linked)
        u, v = forest(ids[i], ids[j])
        return pd.concat([pd.DataFrame({"u": ids[some], "v": None, "links": linked[some].astype(np.int64)}),
                          pd.DataFrame({"u": u, "v": v, "links": np.zeros(len(u), np.int64)})]).astype({"v": "Int64"})

    return dealt.groupBy("key").applyInPandas(links, "u long, v long, links long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = COSINE) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Vectors that are null, empty, all zero or hold null or non-finite components, and
    rows with a null id, link with nothing (n_links 0, a component of their own).
    Identical vectors form one class before the search and link with each other; rows
    that repeat an id are one node of the components, and each counts as a link. Of
    vectors of different lengths the shorter is padded with zeros. An empty table gives
    no rows; other columns are ignored.
    """
    # components given as floats travel as floats, half as wide; cosines are computed in doubles
    kind = "array<float>" if vectors.schema[vector_col].dataType in (ArrayType(FloatType(), True), ArrayType(FloatType(), False)) else "array<double>"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(kind).alias("v"))
    valid = finite(F.col("v")) & F.exists("v", lambda x: x != 0) & F.col("id").isNotNull()
    rows = rows.withColumn("v", F.when(F.coalesce(valid, F.lit(False)), F.transform("v", lambda x: x + F.lit(0.0)).cast(kind)))
    rows = rows.withColumn("digest", F.when(F.col("v").isNotNull(), F.sha2(F.col("v").cast("string"), 256)))
    rows = store(rows, "vectors")
    # one class per distinct vector, named by its smallest id
    classes = rows.where("v is not null").groupBy("digest").agg(
        F.min("id").cast("long").alias("id"), F.first("v").alias("v"), F.count(F.lit(1)).alias("n"))
    classes = store(classes, "vector-classes")
    n, width = classes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    described = store(describe(classes.select("id", "v", "n"), n, width), "described")
    linked = store(link_lists(described, width, cosine), "vector-links")
    counts = linked.groupBy("u").agg(F.sum("links").alias("links")).withColumnRenamed("u", "_u")
    parts = connected_components(linked.where("v is not null").select("u", "v"))
    whole = classes.select("digest", "id", "n").join(parts, F.col("id") == F.col("node"), "left") \
        .join(counts, F.col("id") == F.col("_u"), "left")
    whole = whole.select("digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                         F.coalesce("component", "id").alias("component_id"))
    out = rows.select("id", "digest").join(whole, "digest", "left")
    component = F.coalesce("component_id", F.col("id").cast("long"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
