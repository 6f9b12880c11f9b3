"""M6-M8, K5: naive Bayes asked on tables, without vectors.

A document scores ``pi_c + sum_f value_f * theta_cf`` for a class c. Only observed (class,
feature) pairs have a ``theta``; every other pair has the class's ``theta_unseen``. So a
score is ``pi_c + total * theta_unseen_c`` plus ``value * (theta - theta_unseen)`` summed
over the document's entries that meet an observed pair: one join on the feature.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtext.operators.sizing import broadcast_if_small
from loomtext.session import reliable_checkpoint

BLOCK = 8  # classes in a row of gains
RANK_DECIMALS = 9  # scores equal at so many decimals tie, and the smaller label wins


@dataclass
class Bayes:
    """``priors(label, n_docs, pi, theta_unseen)`` and ``theta(label, fidx, theta)``."""

    priors: DataFrame
    theta: DataFrame

    def save(self, path: str) -> None:
        """K5: both tables under ``path`` (overwritten)."""
        self.priors.write.mode("overwrite").parquet(f"{path}/pi")
        self.theta.write.mode("overwrite").parquet(f"{path}/theta")


def load_bayes(spark: SparkSession, path: str) -> Bayes:
    return Bayes(spark.read.parquet(f"{path}/pi"), spark.read.parquet(f"{path}/theta"))


def score_classes(model: Bayes, entries: DataFrame, docs: DataFrame) -> DataFrame:
    """``(doc_id, label, n_entries, class, score)`` for every document and class.

    The classes are one row each, a list that every task holds, and stand ``BLOCK`` to a
    row of gains: an entry meets one row of its feature per block, not one per class, and
    entries fold to one row per document and block before they are shuffled. Gains are
    broadcast behind a check of their bytes, else joined by feature."""
    classes = model.priors.agg(F.collect_list(F.struct(F.col("label").alias("class"), "pi", "theta_unseen"))).scalar()
    order = Window.orderBy("label")  # one row per class
    places = F.broadcast(model.priors.select(F.col("label").alias("class"), "theta_unseen", (F.row_number().over(order) - 1).alias("at")))
    gain = F.col("theta") - F.col("theta_unseen")
    held = model.theta.withColumnRenamed("label", "class").join(places, "class") \
        .groupBy("fidx", F.floor(F.col("at") / BLOCK).cast("int").alias("block")) \
        .agg(*[F.sum(F.when(F.col("at") % BLOCK == k, gain)).alias(f"g{k}") for k in range(BLOCK)])
    held = reliable_checkpoint(held, "bayes-gains")
    met = entries.select("doc_id", "fidx", "value").join(broadcast_if_small(held), "fidx")
    sums = met.groupBy("doc_id", "block").agg(*[F.sum(F.col("value") * F.col(f"g{k}")).alias(f"g{k}") for k in range(BLOCK)])
    more = sums.select("doc_id", "block", F.posexplode(F.array(*[f"g{k}" for k in range(BLOCK)])).alias("k", "gain"))
    more = more.where("gain is not null").withColumn("at", F.col("block") * BLOCK + F.col("k")) \
        .join(places, "at").select("doc_id", "class", "gain")
    totals = entries.groupBy("doc_id").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n_entries"))
    base = docs.select("doc_id", "label").join(totals, "doc_id", "left").withColumn("c", F.explode(classes)).select(
        "doc_id", "label", F.coalesce("n_entries", F.lit(0)).alias("n_entries"), "c.class",
        (F.col("c.pi") + F.coalesce("total", F.lit(0)) * F.col("c.theta_unseen")).alias("base"))
    out = base.join(more, ["doc_id", "class"], "left")
    return out.select("doc_id", "label", "n_entries", "class", (F.col("base") + F.coalesce("gain", F.lit(0.0))).alias("score"))


def predict_bayes(model: Bayes, entries: DataFrame, docs: DataFrame) -> DataFrame:
    """M7, M8: ``(doc_id, label, n_entries, prediction)``, the class of the largest score."""
    ranked = F.struct(F.round("score", RANK_DECIMALS).alias("s"), (-F.col("class")).alias("c"))
    scored = score_classes(model, entries, docs)
    best = scored.groupBy("doc_id", "label", "n_entries").agg(F.max(ranked).alias("b"))
    return best.select("doc_id", "label", "n_entries", (-F.col("b.c")).alias("prediction"))
