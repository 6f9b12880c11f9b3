"""Packing by optimal length buckets.

Dynamic programming over the global histogram of lengths picks the ``buckets`` upper
bounds with the least padding; inside a bucket, token-budget batches hold as many rows,
padded to the bucket's bound, as the budget allows.
"""

from __future__ import annotations

from bisect import bisect_left
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import WORD, running_offsets, store
from loomtext.llm.mixing import BUCKET_ROWS, id_hash

BUCKETS = 16
BATCH_TOKENS = 65_536
# Lengths up to here have a histogram bin each; above, a bin is 1/1024 of its power of
# two wide, so the histogram that the driver sees has at most 4096 + 1024 * 51 bins.
# A bin carries its longest row, rows and words, so bounds are lengths that rows have and
# costs are exact; only cuts inside a bin are not looked at. Moving such a cut to its
# bin's longest row pads a row by less than 1/1024 of its bucket's bound.
EXACT = 4096


def histogram_bin(length: Column) -> Column:
    """The bin of ``length``: the largest length that falls in it."""
    power = F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double")))
    step = F.pow(F.lit(2.0), F.greatest(power - 10, F.lit(0))).cast("long")
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / step) * step).cast("long")


def length_histogram(sized: DataFrame, length_col: str = "n_tokens") -> list[tuple[int, int, int]]:
    """(longest length, rows, words) of every bin in use; bounded, see EXACT."""
    n = F.col(length_col)
    bins = sized.groupBy(histogram_bin(n).alias("bin")).agg(F.max(n).alias("top"), F.count(n).alias("rows"), F.sum(n).alias("words"))
    return sorted((int(r["top"]), int(r["rows"]), int(r["words"])) for r in bins.collect())


def optimal_bounds(histogram: list[tuple], buckets: int = BUCKETS) -> list[int]:
    """At most ``buckets`` upper bounds, the last the largest length, that minimise the
    sum of (bound - length). ``histogram`` has (length, rows) or, for bins of several
    lengths, (longest length, rows, words). Exact: minimum over the ends of bins by the
    convex hull of lines (slopes fall, lengths rise), buckets x bins steps. Ties take the
    earliest cut."""
    rows = sorted(histogram)
    if not rows:
        return []
    length = [x for x, *_ in rows]
    count, total = [0], [0]
    for x, n, *words in rows:
        count.append(count[-1] + n)
        total.append(total[-1] + (words[0] if words else n * x))
    m = len(rows)
    cost: list = [0] + [None] * m
    cuts = []
    for _ in range(min(buckets, m)):
        fresh, chosen, hull, at = [None] * (m + 1), [0] * (m + 1), [], 0
        for j in range(1, m + 1):
            i = j - 1
            if cost[i] is not None:
                line = (-count[i], cost[i] + total[i], i)  # cost of a bucket from i, as a function of its bound
                while len(hull) > 1 and _crossing(hull[-2], line) <= _crossing(hull[-2], hull[-1]):
                    hull.pop()
                hull.append(line)
            if hull:
                at = min(at, len(hull) - 1)
                x = length[j - 1]
                while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                    at += 1
                slope, rest, i = hull[at]
                fresh[j], chosen[j] = slope * x + rest + x * count[j] - total[j], i
        cost = fresh
        cuts.append(chosen)
    bounds, j = [], m
    for chosen in reversed(cuts):
        bounds.append(length[j - 1])
        j = chosen[j]
    return bounds[::-1]


def _crossing(a: tuple, b: tuple) -> Fraction | float:
    return float("inf") if a[0] == b[0] and b[1] >= a[1] else float("-inf") if a[0] == b[0] \
        else Fraction(b[1] - a[1], a[0] - b[0])


def bucket_of(length: Column, bounds: list[int]) -> Column:
    """Index of the first bound that is at least ``length``."""
    out = F.lit(len(bounds) - 1 if bounds else 0)
    for i, b in reversed(list(enumerate(bounds[:-1]))):
        out = F.when(length <= b, F.lit(i)).otherwise(out)
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
         batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """One row per input row: id, n_tokens (words), bucket, bucket_tokens (its bound),
    batch (in the bucket, from 0), place (in the batch, from 0), padding.

    Batches of a bucket take rows in the order of an id hash, then id, then length; a
    row longer than the budget is a batch alone, never cut. Null and empty texts have
    length 0 and sit in the first bucket; the last bucket's bound is the longest row;
    repeated rows are packed each; an empty table gives no rows; other columns, whatever
    their names, are ignored.
    """
    n = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    sized = store(docs.select(F.col(id_col).alias("id"), n.alias("n_tokens")), "pack-lengths")
    histogram = length_histogram(sized)
    bounds = optimal_bounds(histogram, buckets)
    total = sum(n for _, n, _ in histogram)
    tops = F.array(*[F.lit(b).cast("long") for b in bounds or [0]])
    dealt = sized.withColumn("bucket", bucket_of(F.col("n_tokens"), bounds).cast("int")) \
        .withColumn("bucket_tokens", F.element_at(tops, F.col("bucket") + 1))
    placed = running_offsets(dealt, ["bucket"], [F.col("id"), F.col("n_tokens")], id_hash(F.col("id")), F.lit(1),
                             max(1, -(-total // BUCKET_ROWS)), "nth")
    room = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.greatest("bucket_tokens", F.lit(1)))).cast("long")
    return placed.select(F.col("id").alias(id_col), "n_tokens", "bucket", "bucket_tokens",
                         F.floor(F.col("nth") / room).alias("batch"), (F.col("nth") % room).alias("place"),
                         (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding"))


def padding(histogram: list[tuple[int, int]], bounds: list[int]) -> int:
    """Tokens of padding that the bounds cost on a histogram."""
    return sum(n * (bounds[bisect_left(bounds, x)] - x) for x, n in histogram)
