"""Label records by the best URL-substring rule.

A rule ``pattern``tag`` hits a record when the record's URL field text contains
``pattern``. Among hits the best rule has (1) the most ``.``-separated pieces in its
whole literal ``pattern + "``" + tag``, then (2) the longest literal, then (3) the
earliest ``ord``. The ranking depends on the rule alone, so every rule gets one
``rank_key`` (smaller is better; pattern and tag break ties) and the best hit is a ``min``.

Plan: the substring test is an equi-join on k-grams. Patterns fall into length classes
(``GRAM_SIZES``); a pattern of a class with k characters is indexed by one of its own
k-grams, the one that costs the join the least: the patterns that contain it times the URLs
that do (a sketch of hash slots, over a share of the URLs). So neither a start that many
patterns share ("www.") nor a piece that most URLs share indexes a pattern, and one short
pattern does not shorten the grams of the others. The choice alters no result. Each distinct URL explodes its grams of the classes in use, joins the index and
keeps rows whose text really contains the pattern. A text that contains a pattern
contains each of its grams, so no hit is lost. One partial + final aggregate per URL then
takes ``min(rank_key)``, and the labels join the records on the URL; records with no hit
disappear (F1). No record column but the URL enters the grams, and no nested-loop join
is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions.text import java_trim
from loomtext.operators.sampling import hash_sample
from loomtext.operators.sizing import BROADCAST_BYTES, fits, row_bytes
from loomtext.session import reliable_checkpoint
from loomtext.functions.arrays import explode_rows

RULE_SEP = "``"
GRAM_SIZES = (1, 2, 4, 8)  # a pattern takes the largest that it is long enough for
SKETCH_SLOTS = 1 << 18  # counters of the URL sketch: 4 MB when broadcast
URL_SHARE = 1 / 16  # of the distinct URLs that the sketch of one call counts
SKETCH_SALT = "sketch:"


def parse_rule_lines(lines: DataFrame, value: str = "value", ord_col: str = "ord") -> DataFrame:
    """Rule lines ``pattern``tag`` -> ``(ord, pattern, tag)``; lines without ``````
    are ignored. ``ord`` must already give the list order."""
    v = F.col(value)
    at = F.instr(v, RULE_SEP)
    return (lines.where(at > 0)
            .select(F.col(ord_col).cast("long").alias("ord"),
                    F.expr(f"substring({value}, 1, instr({value}, '``') - 1)").alias("pattern"),
                    F.expr(f"substring({value}, instr({value}, '``') + 2)").alias("tag")))


def rule_pieces(literal: Column) -> Column:
    """``literal.split("\\\\.").length`` (trailing empty pieces dropped)."""
    stripped = F.regexp_replace(literal, r"\.+$", "")
    dots = F.length(stripped) - F.length(F.replace(stripped, F.lit("."), F.lit("")))
    return F.when(stripped == "", F.lit(0)).otherwise(dots + 1)


def ranked_rules(rules: DataFrame) -> DataFrame:
    """Add ``pieces``, ``lit_len``, ``rank_key`` (a struct, smaller wins) and ``category``."""
    literal = F.concat(F.col("pattern"), F.lit(RULE_SEP), F.col("tag"))
    r = rules.select(F.col("ord").cast("long").alias("ord"), "pattern", "tag",
                     rule_pieces(literal).alias("pieces"), F.length(literal).alias("lit_len"))
    key = F.struct((-F.col("pieces")).alias("pieces"), (-F.col("lit_len")).alias("lit_len"), "ord", "pattern", "tag")
    return r.withColumn("rank_key", key).withColumn("category", java_trim("tag"))


def gram_size(length: Column) -> Column:
    """k of the class of patterns with ``length`` characters (0 for an empty one)."""
    return F.greatest(*[F.when(length >= k, F.lit(k)).otherwise(F.lit(0)) for k in GRAM_SIZES])


def gram_slot(gram: Column) -> Column:
    """The sketch counter of a gram."""
    return F.pmod(F.xxhash64(gram), F.lit(SKETCH_SLOTS))


def url_sketch(records: DataFrame, sizes: list[int], url: str = "url", field_prefix: str = "url=") -> DataFrame:
    """``(_slot, _urls)``: how many distinct URLs hold a gram of the slot, at least the
    number of each of its grams. At most ``SKETCH_SLOTS`` rows, counted before the shuffle;
    sketches of several days add up."""
    grams = url_grams(records, sizes, url, field_prefix)
    return grams.groupBy(gram_slot(F.col("_gram")).alias("_slot")).agg(F.count(F.lit(1)).alias("_urls"))


def index_rules(rules: DataFrame, records: DataFrame | None = None, url: str = "url",
                field_prefix: str = "url=") -> DataFrame:
    """The stored index ``(_gram, _pat, _rk, k)`` of a rule table, one row per distinct
    pattern: its best rule's rank (rules of one pattern hit together) and the k-gram with
    the smallest product of the patterns and the URLs of ``records`` that contain it (the
    patterns alone without records); of equal ones the one nearest the middle."""
    best = ranked_rules(rules).where("pattern is not null").groupBy(F.col("pattern").alias("_pat")) \
        .agg(F.min("rank_key").alias("_rk"))
    best = reliable_checkpoint(best.withColumn("k", gram_size(F.length("_pat"))), "rules")
    n = F.length("_pat")
    spots = F.transform(F.sequence(F.lit(1), F.greatest(n - F.col("k") + 1, F.lit(1))), lambda i: F.struct(
        F.substring("_pat", i, F.col("k")).alias("gram"), F.abs(2 * i + F.col("k") - n - 2).alias("off")))
    grams = explode_rows(best.withColumn("_spots", spots), F.col("_spots"), "_at", ("_pat",))
    grams = grams.groupBy("_pat", F.col("_at.gram").alias("_gram")).agg(F.min("_at.off").alias("_off"))
    held = grams.groupBy(F.col("_gram").alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    weighed = grams.join(held, F.col("_gram") == F.col("_g")).withColumn("_cost", F.lit(0).cast("long"))
    sizes = [r["k"] for r in best.select("k").distinct().collect() if r["k"]] if records is not None else []
    if sizes:
        seen = F.broadcast(url_sketch(records, sizes, url, field_prefix))  # SKETCH_SLOTS rows at most
        weighed = weighed.join(seen, gram_slot(F.col("_gram")) == F.col("_slot"), "left") \
            .withColumn("_cost", F.col("_n") * F.coalesce("_urls", F.lit(0)))
    rarest = weighed.groupBy("_pat").agg(F.min(F.struct("_cost", "_n", "_off", "_gram")).alias("_best")) \
        .select(F.col("_pat").alias("_p"), "_best._gram")
    return reliable_checkpoint(best.join(rarest, F.col("_pat") == F.col("_p")).select("_gram", "_pat", "_rk", "k"),
                               "rule-index")


def kgrams(text: Column, k: int) -> Column:
    """Distinct k-character substrings of ``text`` (empty when shorter than k).

    ``text`` should be a column reference: a lambda re-evaluates a captured
    expression for every element."""
    n = F.length(text) - F.lit(k) + 1
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(text, i, k))
    return F.when(n >= 1, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def url_grams(records: DataFrame, sizes: list[int], url: str = "url", field_prefix: str = "url=") -> DataFrame:
    """``(_url, _hay, _gram)``: every distinct URL with its distinct grams of the sizes."""
    urls = records.select(F.col(url).alias("_url")).where(F.col("_url").isNotNull()).distinct()
    with_hay = urls.select("_url", F.concat(F.lit(field_prefix), F.col("_url")).alias("_hay"))
    grams = F.concat(*[kgrams(F.col("_hay"), k) for k in sizes])
    return explode_rows(with_hay, grams, "_gram", keep=("_url", "_hay"))


def classify(records: DataFrame, rules: DataFrame | None, url: str = "url", field_prefix: str = "url=",
             broadcast_bytes: int = BROADCAST_BYTES, gram_salts: int = 8, index: DataFrame | None = None) -> DataFrame:
    """J1 + F1: every column of ``records`` plus ``pattern``, ``tag``, ``category`` of
    the best hit; records with no hit (or no URL) are dropped.

    The URL is matched as the record field text, i.e. with ``field_prefix`` in front, as
    the raw log line presents it. Each distinct URL is labelled once (the distinct is a
    partial aggregate, so a hot URL collapses per partition); the join back is an
    equi-join on the URL whose hot keys AQE splits.

    The rules are indexed and stored once per call; ``index`` (from :func:`index_rules`)
    lets several calls share one.
    """
    if index is None:
        index = index_rules(rules, hash_sample(records.select(url), url, URL_SHARE, SKETCH_SALT), url, field_prefix)
    flat = index.select("_gram", "_pat", "_rk.*", "k")
    sizes, held = flat.agg(F.sort_array(F.collect_set("k")), F.sum(row_bytes(flat))).first()  # len(GRAM_SIZES) + 1 at most
    if 0 in sizes:
        raise ValueError("rule patterns must be non-empty")
    by_gram = index.select("_gram", "_pat", "_rk")
    grams = url_grams(records, sizes or [max(GRAM_SIZES)], url, field_prefix)
    if int(held or 0) <= broadcast_bytes:
        hits = grams.join(F.broadcast(by_gram), "_gram")
    else:
        # Shuffled join: most URL grams ("url=http", ...) index no rule and would pile onto
        # a few join keys. When the distinct index grams fit the broadcast bound, drop
        # those URL grams before the shuffle; a shuffled pre-filter would meet the same
        # hot keys, so none then.
        known = by_gram.select("_gram").distinct()
        if fits(known, broadcast_bytes):
            grams = grams.join(F.broadcast(known), "_gram", "left_semi")
        # Grams that do index rules can still be hot: salt the URL side and copy each
        # rule once per salt, so one gram's rows spread over ``gram_salts`` join
        # partitions (every pair still meets exactly once).
        grams = grams.withColumn("_salt", F.pmod(F.hash("_url"), F.lit(gram_salts)))
        by_gram = by_gram.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(gram_salts - 1))))
        hits = grams.join(by_gram, ["_gram", "_salt"])
    best = hits.where(F.instr(F.col("_hay"), F.col("_pat")) > 0).groupBy("_url").agg(F.min("_rk").alias("_rk"))
    best = best.select("_url", "_rk.pattern", "_rk.tag").withColumn("category", java_trim("tag"))
    return records.join(best, F.col(url) == F.col("_url")).drop("_url")


def rules_frame(spark: SparkSession, rows: list[tuple[int, str, str]]) -> DataFrame:
    """A rule table from ``(ord, pattern, tag)`` tuples."""
    return spark.createDataFrame(rows, "ord long, pattern string, tag string")
