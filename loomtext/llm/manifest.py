"""Merkle manifest of a dataset: every row a leaf, a proof and a check for each.

A row's rank inside its group gives the binary digits of its place in the group's tree.
Within a block of ``2 ** digits`` consecutive nodes the digits are grouped away one after
the other, the lowest first: each grouping nests the one or two children of a node in its
struct. A block is dealt out once by (group, block), so all its groupings run in one task
over one sort. Block digests are the nodes of the next tier of blocks, until a group has
one. From the top down, a transform over the nested structs and an explode then give
every child the siblings on its way up; a tier's blocks meet the path of their own node by
grouping, not by a join. Group digests form a tree of the same kind above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.common import store
from loomtext.operators.sizing import broadcast_if_small

DIGITS = 8  # of a rank in one block: 256 nodes, whose nested struct is one row
TAMPER_MOD = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def counted_field(col: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    text = col.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (grp, id, digest, ...) with rank (from 0 in its group, by id, null first,
    then digest) and n (rows of the group).

    Range partitions split a group of any size, a third place separates equal rows. The
    range index and the place in it are stored, so sampled borders cannot move; a group's
    bases come from one row per range that it has rows in."""
    told = store(rows, "manifest-rows").withColumn("_at", F.monotonically_increasing_id())
    order = ("grp", "id", "digest", "_at")
    dealt = told.repartitionByRange(*order).sortWithinPartitions(*order).drop("_at")
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    fixed = store(dealt.withColumn("_range", F.spark_partition_id()).withColumn("_place", place), "manifest-ranges")
    counts = fixed.groupBy("_range", "grp").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    of_group = Window.partitionBy("grp")
    before = F.sum("_n").over(of_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select(F.col("_range").alias("_r"), F.col("grp").alias("_g"), F.sum("_n").over(of_group).alias("n"),
                          (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_base"))
    met = fixed.join(broadcast_if_small(bases), (F.col("_range") == F.col("_r")) & F.col("grp").eqNullSafe(F.col("_g")))
    return met.withColumn("rank", F.col("_place") + F.col("_base")).drop("_range", "_place", "_r", "_g", "_base")


def _active(level: int) -> Column:
    """True where a group of ``n`` nodes has several nodes left at a level of its block."""
    return F.col("n") > (1 << level)


def roll_up(nodes: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(grp, block, n, node): nodes (grp, rank, n, digest, own) nested block by block. A
    node is a struct of its digest and its kids; those of the lowest level hold ``own``.
    A node that stands alone on its level while others remain on it is hashed alone."""
    names = [f"d{j}" for j in range(digits)]
    out = nodes.select("grp", F.shiftright("rank", digits).alias("block"), "n",
                       *[F.shiftright("rank", j).bitwiseAND(F.lit(1)).alias(d) for j, d in enumerate(names)],
                       F.struct("digest", "own").alias("node")).repartition("grp", "block")
    for j, d in enumerate(names):
        keys = ["grp", "block", "n", *reversed(names[j + 1:])]  # each a prefix of the one before: one sort serves all
        pair = out.groupBy(*keys).agg(F.first(F.when(F.col(d) == 0, F.col("node")), ignorenulls=True).alias("one"),
                                      F.first(F.when(F.col(d) == 1, F.col("node")), ignorenulls=True).alias("two"))
        both = digest(F.col("one.digest"), F.coalesce(F.col("two.digest"), F.lit("")))
        kids = F.when(F.col("two").isNull(), F.array("one")).otherwise(F.array("one", "two"))
        out = pair.select(*keys, F.struct(F.when(_active(j), both).otherwise(F.col("one.digest")).alias("digest"),
                                          kids.alias("kids")).alias("node"))
    return out


def _paths(node: Column, level: int, path: Column) -> Column:
    """Array of (own, digest, path) of all nodes under ``node``: path has a step (left,
    right) for each level, lowest first, either of them the sibling's digest or empty."""
    if level < 0:
        return F.array(F.struct(node["own"].alias("own"), node["digest"].alias("digest"), path.alias("path")))

    def below(kid: Column, i: Column) -> Column:
        left = F.when(i == 1, node["kids"][0]["digest"]).otherwise(F.lit(""))
        right = F.when((i == 0) & (F.size(node["kids"]) == 2), F.get(node["kids"], F.lit(1))["digest"]).otherwise(F.lit(""))
        step = F.when(_active(level), F.array(F.struct(left.alias("left"), right.alias("right"))))
        return _paths(kid, level - 1, F.concat(F.coalesce(step, no_steps()), path))

    return F.flatten(F.transform(node["kids"], below))


def no_steps() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")


def tiers(nodes: DataFrame, digits: int = DIGITS) -> list[DataFrame]:
    """The stored blocks of every tier, the lowest first; the last has one block a group."""
    most, found = nodes.agg(F.max("n")).first()[0] or 1, []
    while True:
        blocks = store(roll_up(nodes, digits), "manifest-blocks")
        found.append(blocks)
        most = -(-most >> digits)  # ceil(most / 2 ** digits)
        if most <= 1:
            return found
        nodes = blocks.select("grp", F.col("block").alias("rank"),
                              F.expr(f"shiftright(n + {(1 << digits) - 1}, {digits})").alias("n"),
                              F.col("node.digest").alias("digest"), F.struct("block").alias("own"))


def unroll(found: list[DataFrame], tops: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(grp, own, digest, up): every lowest node under ``tops`` (grp, up), where up is a
    struct whose path leads on from the group's last node; paths grow from below."""
    at = tops.select("grp", F.lit(0).cast("long").alias("block"), "up")
    rest = [f.name for f in tops.schema["up"].dataType.fields if f.name != "path"]
    for k, blocks in reversed(list(enumerate(found))):
        both = blocks.unionByName(at, allowMissingColumns=True)
        met = both.groupBy("grp", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "up")])
        low = met.select("grp", "up", F.explode(_paths(F.col("node"), digits - 1, no_steps())).alias("low"))
        up = F.struct(F.concat("low.path", "up.path").alias("path"), *[F.col(f"up.{c}").alias(c) for c in rest])
        at = low.select("grp", up.alias("up"), "low.own", "low.digest")
        if k:
            at = at.select("grp", F.col("own.block").alias("block"), "up")
    return at


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda d, s: digest(s["left"], d, s["right"]))


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS,
                    count_col: str = "n_chars", digits: int = DIGITS) -> DataFrame:
    """One row per input row: id, leaf, subroot (of its group), root, path (sibling steps
    from the leaf to the root), proof_sha256, folded_root, verified.

    A leaf hashes ``fields`` in order. folded_root starts from the leaf of the row with
    ``count_col`` one higher where 7 divides the CRC-32 of the id's text, else from the
    leaf itself. Null fields hash as ``-``, a null group is a group of its own (the
    first), null ids come first in their group and are never tampered with; equal ids are
    ordered by leaf, equal rows are leaves of their own; a text of any length is one hash;
    an empty table gives no rows; other columns, whatever their names, are not read.
    """
    of = {c: F.col(f"`{c}`") for c in {*fields, id_col, group_col, count_col}}
    one_more = {**of, count_col: (of[count_col] + 1).cast(docs.schema[count_col].dataType)}
    hit = F.coalesce(F.crc32(of[id_col].cast("string")) % TAMPER_MOD == 0, F.lit(False))
    leaf, altered = [digest(*[counted_field(x[c]) for c in fields]) for x in (of, one_more)]
    rows = docs.select(of[group_col].alias("grp"), of[id_col].alias("id"), leaf.alias("digest"),
                       F.when(hit, altered).alias("altered"))
    nodes = ranked(rows).select("grp", "rank", "n", "digest", F.struct("id", "altered").alias("own"))
    lower = tiers(store(nodes, "manifest-leaves"), digits)
    subroots = lower[-1].select(F.lit(0).alias("grp"), F.col("grp").alias("id"), F.col("node.digest").alias("digest"))
    upper = tiers(ranked(subroots).select("grp", "rank", "n", "digest", F.struct("id").alias("own")), digits)
    root = upper[-1].select("grp", F.struct(no_steps().alias("path"), F.col("node.digest").alias("root")).alias("up"))
    groups = unroll(upper, root, digits).select(F.col("own.id").alias("grp"), F.struct(
        F.col("up.path").alias("path"), F.col("up.root").alias("root"), F.col("digest").alias("subroot")).alias("up"))
    out = unroll(lower, store(groups, "manifest-groups"), digits)
    out = out.select(F.col("own.id").alias(id_col), F.col("digest").alias("leaf"), "own.altered", "up.subroot", "up.root", "up.path")
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    out = out.withColumn("proof_sha256", F.sha2(siblings, 256)) \
        .withColumn("folded_root", folded(F.coalesce("altered", "leaf"), F.col("path")))
    return out.select(F.col(f"`{id_col}`"), "leaf", "subroot", "root", "path", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
