"""The corpus pipeline: five stages over ``documents``, each one operator of loomtext.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. Every stage handles null ids, texts and sources, empty tables and
repeated rows as its operator defines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtext.llm import mixing, packing, quality, secrets, simhash
from loomtext.llm.common import columns_of, running_offsets, store

SHARE = 1 << 28  # a whole document in the running totals of shares
RUN_ROWS = 10_000  # documents in one run of a size class, about


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labels, rates 1; the rest go.
    Null and empty texts are rated as all-zero statistics, equal rows alike, texts of any
    length whole; all columns stay; an empty table gives no rows."""
    labels = columns_of(spark, sf_dir, "labels", "doc_id", "quality")
    score = quality.scorer(quality.train(docs, labels))
    return docs.where(score(F.col("text").cast("string")) >= quality.THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, null
    ids last (of equal ids, the smallest text hash), once if its row repeats. Null and
    empty texts have fingerprint zero and form a group; texts of any length are read
    whole; other columns, whatever their names, stay; an empty table gives no rows."""
    # a row is named by id and text, as an id may repeat with another text
    id_ = F.col("doc_id")
    name = F.struct(id_.isNull().cast("int").alias("no_id"), id_.alias("id"), F.xxhash64("text").alias("hash"))
    found = simhash.simhash_components(docs.select(name.alias("doc_id"), "text"))
    kept = found.where(_same("doc_id", "component_id")).select(F.col("doc_id").alias("kept")).distinct()
    # window and join share one key of one type, never null, so whole rows move once
    same = name.cast(kept.schema["kept"].dataType)
    nth = F.row_number().over(Window.partitionBy("name").orderBy("name"))
    once = docs.select(F.struct("*").alias("row"), same.alias("name")).withColumn("nth", nth).where("nth = 1")
    return once.join(kept, F.col("name") == F.col("kept"), "left_semi").select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that are not widely copied examples are masked in the texts; no row goes.
    Odd rows are handled as :func:`loomtext.llm.secrets.redact` says."""
    return secrets.redact(docs)


def _times(taken: DataFrame) -> DataFrame:
    """``taken`` (id, source, taken, size) with times: taken / size, rounded as a running
    total over a source in the order of quarter-octave size classes (hash order inside),
    so a source's copies, and those of each length, keep their share to about a document."""
    some = taken.where("size > 0")
    share = F.round(F.col("taken") * SHARE / F.greatest("size", F.lit(1))).cast("long")
    runs = -(-taken.count() // RUN_ROWS) or 1
    spread = F.floor(4 * F.log2("size")) * runs + F.pmod(F.xxhash64("id"), F.lit(runs))
    placed = running_offsets(some, ["source"], [F.col("id")], spread, share, 256 * runs, "before")
    up = lambda x: F.shiftright(x + SHARE // 2, SHARE.bit_length() - 1)
    total = up(F.col("before") + share) - up(F.col("before"))
    return placed.select("id", "source", total.cast("int").alias("times")).unionByName(
        taken.where("size = 0").select("id", "source", F.lit(1).alias("times")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words (never row parts), 0 to 3 times,
    so that a source's words come near the taken ones. Documents without words (null and
    empty texts) stay once; rows that share id and source share their times, other columns,
    whatever their names, stay; an empty table gives no rows."""
    taken = store(mixing.mix_sources(docs).groupBy(F.col("doc_id").alias("id"), "source").agg(
        F.sum("taken").alias("taken"), F.sum("size").alias("size")), "mix-taken")
    per = _times(taken).where("times > 0").select(F.col("id").alias("of_id"), F.col("source").alias("of_source"), "times")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.col("source").cast("string").alias("source"))
    met = rows.join(per, _same("id", "of_id") & _same("source", "of_source"))
    return met.withColumn("nth", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's length bucket and batch, as :func:`loomtext.llm.packing.pack` says."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", classify),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", redact_secrets),
    ("mixing sources", mix),
    ("packing", pack),
]

# A classifier learnt from rows and XXH64 fingerprints have no SQL form; tests/llm hold the
# stages against plain versions and against the operators that they call.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each result stored in the shared folder."""
    docs = columns_of(spark, sf_dir, "documents", "*")
    steps = [lambda d, f=f, k=k: store(f(spark, d, sf_dir), f"stage-{k}") for k, (_, f) in enumerate(STAGES[:-1])]
    return STAGES[-1][1](spark, reduce(lambda d, step: step(d), steps, docs), sf_dir)
