"""M5, M7, K5: random forest grown level by level from aggregations, kept as two tables.

One row per document holds its non-zero features as a map to bins. Growing a level takes
one pass: each document is exploded over the trees that drew it, walked down the splits
found so far (a broadcast join a level), exploded over its features and counted by
(tree, node, feature, bin, label). Zero values are never exploded: their bin is what the
node's totals leave. What is counted depends on trees, nodes, features and bins, not on
documents, so choosing the splits is small.

Draws come from hashes of (seed, tree, document) and (seed, tree, node, feature), so a
forest depends on its input rows alone, not on their layout. Sums are integers and a
split's score is two divisions and one addition, so equal inputs give equal forests.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, exp, factorial, sqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtext.operators.sizing import broadcast_if_small
from loomtext.session import reliable_checkpoint

DEFAULT_TREES, DEFAULT_DEPTH, DEFAULT_BINS, DEFAULT_SEED = 100, 4, 32, 7
VOTE = 1_000_000  # a tree's vote, shared among the labels of its leaf
# A Poisson(1) draw is the number of these bounds that 32 random bits reach.
POISSON = tuple(round(2 ** 32 * exp(-1) * sum(1 / factorial(j) for j in range(k + 1))) for k in range(8))
TOTALS = -1  # the feature under which a node's totals are counted


@dataclass
class Forest:
    """``splits(tree, node, fidx, bin, threshold)``: documents with a value above the
    threshold go to node 2n + 1, the others to 2n; the root is 1. ``leaves(tree, node,
    label, votes)``: the votes of a document that ends there."""

    splits: DataFrame
    leaves: DataFrame

    def save(self, path: str) -> None:
        """K5: both tables under ``path`` (overwritten)."""
        self.splits.write.mode("overwrite").parquet(f"{path}/splits")
        self.leaves.write.mode("overwrite").parquet(f"{path}/leaves")


def load_forest(spark: SparkSession, path: str) -> Forest:
    return Forest(spark.read.parquet(f"{path}/splits"), spark.read.parquet(f"{path}/leaves"))


def _bits(md5: Column, part: Column | int = 0) -> Column:
    """32 of the 128 bits of an MD5; ``part`` (0 to 3) says which."""
    return F.conv(F.substring(md5, F.lit(1) + F.lit(8) * part, F.lit(8)), 16, 10).cast("long")


def value_bins(entries: DataFrame, n_docs: int, bins: int = DEFAULT_BINS) -> DataFrame:
    """``(fidx, value, bin)`` of every value that occurs: its rank among the feature's values,
    zero being 0; a feature of more than ``bins`` values has them dealt by quantile."""
    seen = entries.where("value <> 0").groupBy("fidx", "value").agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("fidx")
    by_value = of.orderBy("value")
    below = F.sum("n").over(by_value) - F.col("n") + F.lit(n_docs) - F.sum("n").over(of)  # with the zeros
    rank = F.row_number().over(by_value)
    dealt = F.floor(below * F.lit(bins) / F.lit(n_docs)).cast("int")
    return seen.select("fidx", "value", F.when(F.count(F.lit(1)).over(of) < bins, rank).otherwise(F.greatest(dealt, F.lit(1))).alias("bin"))


def feature_rows(entries: DataFrame, docs: DataFrame, column: str, name: str) -> DataFrame:
    """``(doc_id, label, name)``: a map fidx -> ``column`` for each document of ``docs``."""
    pairs = F.map_from_entries(F.collect_list(F.struct("fidx", column)))
    per = entries.where("value <> 0").groupBy("doc_id").agg(pairs.alias(name))
    kinds = {f.name: f.dataType.simpleString() for f in entries.schema.fields}
    none = F.map_from_arrays(F.array(), F.array()).cast(f"map<{kinds['fidx']},{kinds[column]}>")
    return docs.select("doc_id", "label").join(per, "doc_id", "left").withColumn(name, F.coalesce(name, none))


def with_draws(rows: DataFrame, trees: int, seed: int, bootstrap: bool = True) -> DataFrame:
    """``rows`` with draws: array of (tree, times) of the trees that draw the document."""
    every = F.sequence(F.lit(0), F.lit(trees - 1))
    if not bootstrap:
        return rows.withColumn("draws", F.transform(every, lambda t: F.struct(t.alias("tree"), F.lit(1).alias("times"))))
    # one MD5 serves four trees; the explode makes the hashes a value, which a lambda would
    # compute again for each of its elements
    hashes = F.transform(F.sequence(F.lit(0), F.lit((trees - 1) // 4)), lambda g: F.md5(F.concat_ws(":", F.lit(f"boot{seed}"), g, "doc_id")))
    out = rows.withColumn("_hashes", F.explode(F.array(hashes)))
    bits = F.transform(every, lambda t: F.struct(t.alias("tree"), F.substring(
        F.element_at("_hashes", (F.floor(t / 4) + 1).cast("int")), F.lit(1) + F.lit(8) * (t % 4), F.lit(8)).alias("bits")))
    draws = F.transform(bits, lambda x: F.struct(x["tree"].alias("tree"), sum(
        ((x["bits"] >= f"{bound:08x}").cast("int") for bound in POISSON), F.lit(0)).alias("times")))
    return out.withColumn("draws", F.filter(draws, lambda x: x["times"] > 0)).drop("_hashes")


def walk(rows: DataFrame, levels: list[DataFrame], values: str, bound: str) -> DataFrame:
    """Each row (tree, node, map ``values``) moved down the ``levels`` of splits, whose
    column ``bound`` says how far the left side goes. A level has at most trees x
    2^level splits, which bounds its broadcast."""
    kept = rows.columns
    for splits in levels:
        side = F.broadcast(splits.select("tree", "node", "fidx", F.col(bound).alias("_bound")))
        met = rows.join(side, ["tree", "node"], "left")
        right = (F.coalesce(F.element_at(values, F.col("fidx")), F.lit(0)) > F.col("_bound")).cast("int")
        node = F.when(F.col("fidx").isNull(), F.col("node")).otherwise(F.col("node") * 2 + right).alias("node")
        rows = met.select(*[node if c == "node" else F.col(c) for c in kept])
    return rows


def chosen_features(features: DataFrame, level: int, trees: int, take: int, seed: int) -> DataFrame:
    """``(tree, node, fidx)``: the ``take`` features with the smallest hashes for each
    node of a level."""
    named = features.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    named = named.withColumn("node", F.explode(F.sequence(F.lit(1 << level), F.lit((2 << level) - 1))))
    draw = _bits(F.md5(F.concat_ws(":", F.lit(f"feat{seed}"), "tree", "node", "fidx")))
    order = Window.partitionBy("tree", "node").orderBy(draw, "fidx")
    return named.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= take).select("tree", "node", "fidx")


def best_splits(cells: DataFrame) -> DataFrame:
    """``(tree, node, fidx, bin)`` of each node's best split by gini: cells (tree, node,
    fidx, bin, label, times), a node's totals under the feature ``TOTALS``. Ties: smaller
    feature, smaller bin. Nodes that no split improves are absent."""
    node, feature = ["tree", "node"], ["tree", "node", "fidx"]
    totals = cells.where(F.col("fidx") == TOTALS).select(*node, "label", F.col("times").alias("all"))
    some = cells.where(F.col("fidx") != TOTALS)
    # every (bin, label) of a feature in its node, zero bin first
    at = some.select(*feature, "bin").distinct()
    at = at.unionByName(at.select(*feature).distinct().withColumn("bin", F.lit(0)))
    grid = at.join(totals, node).join(some, [*feature, "bin", "label"], "left").withColumn("times", F.coalesce("times", F.lit(0)))
    of = Window.partitionBy(*feature, "label")
    zero = F.col("all") - F.sum("times").over(of)
    grid = grid.withColumn("times", F.when(F.col("bin") == 0, zero).otherwise(F.col("times")))
    left = F.sum("times").over(of.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    grid = grid.withColumn("left", left).withColumn("right", F.col("all") - left)
    squares = [F.sum(F.col(c) * F.col(c)).alias(f"{c}_sq") for c in ("left", "right", "all")]
    sums = [F.sum(c).alias(c) for c in ("left", "right", "all")]
    scored = grid.groupBy(*feature, "bin").agg(*squares, *sums).where("left > 0 and right > 0")
    share = lambda c: F.col(f"{c}_sq").cast("double") / F.col(c).cast("double")
    scored = scored.withColumn("score", share("left") + share("right")).where(F.col("score") > share("all"))
    best = scored.groupBy(*node).agg(F.min(F.struct((-F.col("score")).alias("s"), "fidx", "bin")).alias("b"))
    return best.select(*node, "b.fidx", "b.bin")


def grow_forest(entries: DataFrame, docs: DataFrame, num_features: int, trees: int = DEFAULT_TREES, depth: int = DEFAULT_DEPTH,
                bins: int = DEFAULT_BINS, seed: int = DEFAULT_SEED, bootstrap: bool = True) -> Forest:
    """M5: ``trees`` gini trees of ``depth`` over ``entries (doc_id, label, fidx, value)`` of
    ``docs (doc_id, label)``. Several trees look at the square root of ``num_features``
    features in each node, a single one at all. Documents without entries count too."""
    docs = reliable_checkpoint(docs.select("doc_id", "label"), "forest-docs")
    n_docs = docs.count()
    of_value = reliable_checkpoint(value_bins(entries, max(1, n_docs), bins), "forest-bins")
    binned = entries.join(broadcast_if_small(of_value), ["fidx", "value"])
    rows = feature_rows(binned.select("doc_id", "fidx", "value", "bin"), docs, "bin", "bins")
    # every pass makes ``trees`` rows of one, so small tables are worth spreading too
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = reliable_checkpoint(with_draws(rows.repartition(parts, "doc_id"), trees, seed, bootstrap), "forest-rows")
    drawn = rows.withColumn("_d", F.explode("draws")).select("label", "bins", "_d.tree", "_d.times", F.lit(1).alias("node"))
    features = reliable_checkpoint(of_value.select("fidx").distinct(), "forest-features")
    take = num_features if trees == 1 else ceil(sqrt(num_features))
    tops = of_value.groupBy("fidx", "bin").agg(F.max("value").alias("threshold"))
    levels: list[DataFrame] = []
    for level in range(depth):
        here = walk(drawn, levels, "bins", "bin").where(F.col("node") >= (1 << level))
        present = F.map_keys("bins")
        if take < num_features:  # trees x 2^level rows of take features, which bounds the broadcast
            names = chosen_features(features, level, trees, take, seed)
            names = names.groupBy("tree", "node").agg(F.collect_list("fidx").alias("looked"))
            here = here.join(F.broadcast(names), ["tree", "node"])
            present = F.array_intersect("looked", present)
        # a node's totals and its features' cells come from one pass
        cell = lambda f, b: F.struct(f.cast("long").alias("fidx"), b.cast("int").alias("bin"))
        items = F.concat(F.array(cell(F.lit(TOTALS), F.lit(0))), F.transform(present, lambda f: cell(f, F.element_at("bins", f))))
        here = here.select("tree", "node", "label", "times", F.explode(items).alias("i")).select("tree", "node", "label", "times", "i.*")
        cells = here.groupBy("tree", "node", "fidx", "bin", "label").agg(F.sum("times").alias("times"))
        found = best_splits(reliable_checkpoint(cells, "forest-cells")).join(tops, ["fidx", "bin"], "left")
        low = found.select("tree", "node", "fidx", "bin", F.coalesce("threshold", F.lit(0)).alias("threshold"))
        levels.append(reliable_checkpoint(low, "forest-splits"))
    ends = walk(drawn, levels, "bins", "bin").groupBy("tree", "node", "label").agg(F.sum("times").alias("times"))
    share = F.col("times") / F.sum("times").over(Window.partitionBy("tree", "node"))
    leaves = ends.select("tree", "node", "label", F.round(share * VOTE).cast("long").alias("votes"))
    splits = levels[0]
    for more in levels[1:]:
        splits = splits.unionByName(more)
    return Forest(splits, reliable_checkpoint(leaves, "forest-leaves"))


def predict_forest(model: Forest, entries: DataFrame, docs: DataFrame, trees: int, depth: int = DEFAULT_DEPTH) -> DataFrame:
    """M7: ``(doc_id, label, prediction)``: the label with the most votes of all trees (ties:
    the smallest), null where the forest has no leaf."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = feature_rows(entries, docs, "value", "held").repartition(parts, "doc_id")
    rows = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    rows = rows.withColumn("node", F.lit(1))
    levels = [model.splits.where((F.col("node") >= (1 << k)) & (F.col("node") < (2 << k))) for k in range(depth)]
    ends = walk(rows, levels, "held", "threshold").select("doc_id", "label", "tree", "node")
    # at most trees x 2^depth leaves of a few labels each
    leaves = F.broadcast(model.leaves.withColumnRenamed("label", "voted"))
    votes = ends.join(leaves, ["tree", "node"]).groupBy("doc_id", "voted").agg(F.sum("votes").alias("votes"))
    best = votes.groupBy("doc_id").agg(F.min(F.struct((-F.col("votes")).alias("v"), "voted")).alias("b"))
    return docs.select("doc_id", "label").join(best.select("doc_id", F.col("b.voted").alias("prediction")), "doc_id", "left")
