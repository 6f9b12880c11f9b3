"""Mixing sources to target weights.

Every source's documents, in a hash order, form one token stream cut into blocks of
``block_words``. The mix has as many slots as the targets need. Each slot draws its output
shard by a hash, independently of all others, so the shards' counts of every source are
multinomial draws that add up to the source's slots, and the targets are met whatever the
draw. A slot's rank within its source is mapped through a pseudorandom permutation of that
source's block indexes, one per pass; blocks join the slots by (source, block). DataFrame
expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.functions.arrays import repeat_rows
from loomtext.llm.common import WORD, running_offsets, store

BLOCK_WORDS = 128
SHARD_SLOTS = 1024  # slots of a shard, on average
WEIGHTS = (1, 2, 3)
CAP = 3
SEED = 17
ROUNDS = 12
BUCKET_ROWS = 500
NUMBER = "CAST(conv({}, 16, 10) AS BIGINT)"  # Spark's number from hex digits


def permute_round(x: str, n: str, salt: str, r: str, number: str = NUMBER) -> str:
    """SQL (for any engine with its ``number`` from hex digits) of one swap-or-not round on
    0 <= x < n: x and its mirror image under the round's key change places if a hash of
    the larger of the two says so. Any number of rounds is a permutation of 0..n-1. Keys
    have 60 bits, so they reach every place of any n up to there."""
    named = lambda *parts: ", ".join(f"CAST({c} AS STRING)" for c in parts)
    key = "(" + number.format(f"substr(md5(concat_ws(':', 'key', {named(salt, r)})), 1, 15)") + f" % {n})"
    mirror = f"(({key} - {x} + {n}) % {n})"
    hashed = f"md5(concat_ws(':', {named(salt, r, f'greatest({x}, {mirror})')}))"
    return f"CASE WHEN substr({hashed}, 1, 1) < '8' THEN {mirror} ELSE {x} END"


def permuted(x: str, n: str, salt: str, rounds: int = ROUNDS) -> str:
    """SQL of the image of x (below n) under the permutation that salt names."""
    steps = ", ".join(map(str, range(rounds)))
    one = permute_round("x", f"CAST({n} AS BIGINT)", salt, "r")
    return f"aggregate(array({steps}), CAST({x} AS BIGINT), (x, r) -> {one})"


def id_hash(col: Column) -> Column:
    """32 bits of the MD5 of an id's text (0 for a null id)."""
    return F.coalesce(F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(0))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per source: source, rank (from 0 by code point, null last), source_size,
    target. Targets share the total size by weight; a source stops at ``cap`` times its
    size and what it leaves is shared by weight again. One row per source goes through
    one ordered window."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("rank", F.row_number().over(by_name).cast("long") - 1).withColumn("w", w) \
        .withColumn("most", (F.col("source_size") * cap).cast("long"))
    order = Window.orderBy(F.col("most") / F.col("w"), "rank")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(ahead), F.lit(0))
    open_w = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(ahead), F.lit(0))
    # in rising order of most / w, the first source that its share does not overfill sets the level
    level = ranked.withColumn("level", left.cast("double") / open_w.cast("double"))
    fits = F.when(F.col("level") <= F.col("most") / F.col("w"), F.struct(F.col("most") / F.col("w"), "rank", "level"))
    level = level.withColumn("level", F.min(fits).over(everything)["level"])
    return level.withColumn("target", F.least(F.col("most").cast("double"), F.col("level") * F.col("w"))) \
        .select("source", "rank", "source_size", "target")


def plan_sources(sized: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """source_targets plus blocks, full_blocks, passes (whole ones), rest (words of the
    last, partial pass) and slots."""
    t = source_targets(sized).withColumn("goal", F.floor(F.col("target") + 1e-9))
    return t.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("goal") / F.col("source_size"))).otherwise(0)) \
        .withColumn("rest", F.col("goal") - F.col("passes") * F.col("source_size")) \
        .withColumn("blocks", F.ceil(F.col("source_size") / block_words)) \
        .withColumn("full_blocks", F.floor(F.col("source_size") / block_words)) \
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block_words))


def shard_draw(seed: int) -> str:
    """SQL of 60 random bits of the slot ``nth`` of the source ``rank``: the MD5 of both."""
    return f"substr(md5(concat_ws(':', '{seed}', CAST(rank AS STRING), CAST(nth AS STRING))), 1, 15)"


def draw_slots(plan: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS,
               shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row per slot: shard, draw (its order in the shard), rank (of the source), block,
    words (how many of the block's words the slot takes, from its start)."""
    spark = plan.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = int(plan.agg(F.sum("slots")).first()[0] or 0)
    some = plan.where("slots > 0").select("rank", "blocks", "full_blocks", "passes", "rest", "slots")
    step = 1024  # two levels of bounded arrays; runs of slots are dealt out before the last
    runs = some.select("*", F.explode(F.expr(f"sequence(0, (slots - 1) div {step * step})")).alias("hi"))
    runs = runs.select("*", F.explode(F.expr(
        f"sequence(hi * {step}, least(hi * {step} + {step - 1}, (slots - 1) div {step}))")).alias("run")).drop("hi")
    runs = runs.repartition(parts, "rank", "run")
    slots = runs.select("*", F.explode(F.expr(
        f"sequence(run * {step}, least(run * {step} + {step - 1}, slots - 1))")).alias("nth")).drop("run")
    slots = slots.withColumn("pass", F.expr("nth div blocks")).withColumn("at", F.expr("nth % blocks"))
    # the last, shorter block keeps the last place of a pass, so places before it are full
    slots = slots.withColumn("n", F.greatest("full_blocks", F.lit(1))) \
        .withColumn("salt", F.expr(f"{seed} + rank * 7919 + pass * 104729"))
    image = permuted("at", "n", "salt")
    slots = slots.withColumn("block", F.expr(f"CASE WHEN at < full_blocks THEN {image} ELSE at END"))
    left = F.when(F.expr("pass < passes"), F.lit(block_words)).otherwise(F.expr(f"rest - at * {block_words}"))
    slots = slots.withColumn("words", F.least(left, F.lit(block_words)).cast("long"))
    shards = max(1, -(-total // shard_slots))
    draw = F.conv(F.expr(shard_draw(seed)), 16, 10).cast("long")
    return slots.withColumn("draw", draw).select(F.expr(f"draw % {shards}").alias("shard"), F.expr(f"draw div {shards}").alias("draw"),
                                                 "rank", "block", "words")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken, first_shard
    (the first output shard that holds words of the row, or -1), source.

    Null and empty texts have size 0 and are never taken; a null source is a source of
    its own (the last); rows that repeat an id are documents of their own; ties in the
    hash order are broken by id and size; an empty table gives no rows; other columns
    are ignored. taken is at most 3 times the size.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    sized = store(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                              size.alias("size")), "mix-sizes")
    plan = store(plan_sources(sized, block_words), "mix-plan")
    buckets = max(1, -(-sized.count() // BUCKET_ROWS))
    ranked = sized.join(plan.select(F.col("source").alias("_s"), "rank", "source_size", "target"),
                        F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    placed = running_offsets(ranked, ["rank"], [F.col("id"), F.col("size")], id_hash(F.col("id")),
                             F.col("size"), buckets, "start")
    first, last = F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")
    pieces = placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    slots = draw_slots(plan, seed, block_words).select(F.col("rank").alias("_r"), F.col("block").alias("_b"), "words", "shard")
    # the planner takes rows made by explode for few; slots grow with the input, so no broadcast
    met = pieces.join(slots.hint("merge"), (F.col("rank") == F.col("_r")) & (F.col("block") == F.col("_b")), "left")
    begin = F.col("block") * block_words
    got = F.greatest(F.lit(0), F.least(F.col("start") + F.col("size"), begin + F.coalesce("words", F.lit(0)))
                     - F.greatest(F.col("start"), begin))
    # start tells rows of a source with words apart; wordless rows with one id are counted
    keys = ["id", "rank", "source", "start", "size", "source_size", "target"]
    out = met.withColumn("got", got).groupBy(*keys).agg(
        F.coalesce(F.sum("got"), F.lit(0)).alias("taken"),
        F.coalesce(F.min(F.when(F.col("got") > 0, F.col("shard"))), F.lit(-1)).alias("first_shard"),
        F.sum(F.when(F.col("size") == 0, 1).otherwise(0)).alias("rows"))
    out = repeat_rows(out.withColumn("rows", F.greatest("rows", F.lit(1).cast("long"))), "rows", "nth")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "first_shard", "source")
