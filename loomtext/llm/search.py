"""Exact top-k by integer inner product: columnar branch-and-bound.

Candidates lie in blocks, dimension by dimension. For each query, partial sums grow one
block of dimensions at a time; what the rest can still add is at most the product of the
two remaining masses (norms), so candidates whose best case is below the k-th best
worst case leave, and the survivors are compacted. Block results meet in a final top-k.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.functions.arrays import repeat_rows
from loomtext.llm.common import store

K = 10
SCALE = 1024
QUERY_MOD = 100
DIMS = 16  # dimensions in one step
BLOCK_ROWS, QUERY_ROWS = 8192, 512
_EXACT = 2.0 ** 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1  # where scores stop


def finite(vector: Column) -> Column:
    """True for vectors that are not null and hold finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; missing trailing components are zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def quantised(vectors: pd.Series, width: int) -> np.ndarray:
    """floor(1024 x) of every component, as integers held in doubles."""
    return np.floor(matrix(vectors, width) * SCALE)


class Vertical:
    """One candidate block, dimension by dimension, with the masses that remain."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, copies: np.ndarray):
        self.ids, self.copies, self.rows = ids, copies, rows
        self.order = np.argsort(-(rows ** 2).sum(axis=0), kind="stable")  # heavy dimensions first
        columns = rows.T[self.order]
        self.steps = [np.ascontiguousarray(columns[a: a + DIMS]) for a in range(0, len(columns), DIMS)]
        masses = np.array([(s ** 2).sum(axis=0) for s in self.steps]).reshape(len(self.steps), len(rows))
        self.rest = np.sqrt(np.vstack([np.cumsum(masses[::-1], axis=0)[::-1], np.zeros((1, len(rows)))]))

    def top(self, query: np.ndarray, own: tuple, k: int = K) -> tuple[np.ndarray, list[int]]:
        """(places, scores) of the k best, ties to smaller ids, leaving the own row out."""
        live = np.flatnonzero((self.ids != own[0]) | (self.copies != own[1]))
        q = query[self.order]
        sums = np.zeros(len(live))
        # a float sum can be off by far less than this share of the masses' product
        slack = 1e-9 * np.sqrt((q ** 2).sum()) * self.rest[0].max(initial=0) + 1e-6
        for step, columns in enumerate(self.steps):
            part = q[step * DIMS: step * DIMS + DIMS]
            whole = len(live) == len(self.ids)
            sums = sums + part @ (columns if whole else columns[:, live])
            spread = self.rest[step + 1][live] * np.sqrt((q[(step + 1) * DIMS:] ** 2).sum())
            if len(live) > k:
                # scores that stop at an end of 64 bits tie there, however far beyond they are
                worst = sums - spread
                bar = min(np.partition(worst, len(worst) - k)[len(worst) - k], float(_MOST))
                kept = np.maximum(sums + spread, float(_LEAST)) >= bar - slack
                live, sums = live[kept], sums[kept]
        scores = [int(s) for s in np.clip(sums, -2.0 ** 64, 2.0 ** 64)]
        if len(live) and self.rest[0].max() * np.sqrt((query ** 2).sum()) * 2 >= _EXACT:  # beyond doubles: whole numbers
            big = [int(x) for x in query]
            for at in np.flatnonzero(np.abs(sums) < 2.0 ** 64 + slack):
                scores[at] = sum(a * int(b) for a, b in zip(big, self.rows[live[at]], strict=True))
        scores = [max(_LEAST, min(_MOST, s)) for s in scores]
        best = sorted(range(len(live)), key=lambda i: (-scores[i], self.ids[live[i]], self.copies[live[i]]))[:k]
        return live[best], [scores[i] for i in best]


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query: Column | None = None,
          k: int = K, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, id, score): for each query row its k best other rows.

    Queries are the rows whose id is divisible by 100, or for which ``query`` holds.
    Vectors that are null or hold null or non-finite components take no part; rows with a
    null id are candidates only; an empty vector scores 0; of vectors of different lengths the
    shorter counts as padded with zeros. Rows that repeat an id, with the same vector or
    another, are rows and queries of their own: each finds the others. Scores beyond 64 bits
    stop at their ends, where they tie. Ties go to the smaller id, null ids last; an empty
    table gives no rows; other columns are ignored.
    """
    v = F.col(vector_col).cast("array<double>")
    # a null id travels as the largest one, as numbers with gaps would be floats in tasks
    id_ = F.col(id_col).cast("long")
    rows = vectors.where(finite(v)).select(F.coalesce(id_, F.lit(_MOST)).alias("id"), id_.isNotNull().alias("named"), v.alias("v"))
    # equal rows are counted, then told apart by a number
    rows = rows.groupBy("id", "named", F.xxhash64("named", "v").alias("copy")).agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("times"))
    rows = repeat_rows(rows, "times", "nth").withColumn("copy", F.when(F.col("nth") == 1, F.col("copy")).otherwise(
        F.xxhash64("copy", "nth"))).select("id", "named", "copy", "v")
    asks = (F.col("id") % QUERY_MOD == 0) if query is None else query
    rows = store(rows.withColumn("asks", F.col("named") & asks), "search-rows")
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))).first()
    blocks, parts = max(1, -(-n // block_rows)), max(1, -(-n_queries // query_rows))
    mixed = F.xxhash64(F.lit(1), "id", "copy")
    candidates = rows.select("id", "named", "copy", "v", F.pmod(mixed, F.lit(blocks)).alias("block"),
                             F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    queries = rows.where("asks").select("id", "copy", "v", F.pmod(mixed, F.lit(parts)).alias("part"),
                                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def meet(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(c) and len(q):
            width = max(int(c["v"].map(len).max()), int(q["v"].map(len).max()), 1)
            named = c["named"].to_numpy()
            block = Vertical(quantised(c["v"], width), c["id"].to_numpy(), c["copy"].to_numpy())
            for one, id_, copy in zip(quantised(q["v"], width), q["id"], q["copy"], strict=True):
                places, scores = block.top(one, (id_, copy), k)
                out += [(id_, copy, block.ids[p], named[p], block.copies[p], s) for p, s in zip(places, scores, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "query_copy", "id", "named", "copy", "score"]).astype("int64")

    met = candidates.groupBy("block", "part").cogroup(queries.groupBy("block", "part")).applyInPandas(
        meet, "query_id long, query_copy long, id long, named long, copy long, score long")
    best = Window.partitionBy("query_id", "query_copy").orderBy(F.col("score").desc(), "id", F.col("named").desc(), "copy")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", F.when(F.col("named") == 1, F.col("id")).alias(id_col), "score")
