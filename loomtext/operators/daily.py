"""A2, A3, A7, A9 as statistics that are stored per input day and added up, and O1 as a
dictionary that grows.

How many documents of a label hold a feature with a value (``cells``) and how many
documents a label has (``labels``) say all that vocabulary, document frequency, IDF,
chi-square and naive Bayes ask of the texts. Both add up over disjoint inputs, so a new
day is read once and older texts never again. Features are named by their text, as ids
follow from the counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.operators.ids import dense_ids
from loomtext.operators.models import DEFAULT_SMOOTHING, nb_from_sums
from loomtext.operators.select import chi_square_of_groups
from loomtext.operators.vectors import join_vocabulary
from loomtext.operators.vocab import MIN_COUNT, numbered_features


@dataclass
class Statistics:
    """``cells(label, feature, value, n)`` and ``labels(label, n_docs)``."""

    cells: DataFrame
    labels: DataFrame

    def save(self, path: str) -> None:
        """Both tables under ``path``, a folder of the day; written again, a day replaces itself."""
        self.cells.write.mode("overwrite").parquet(f"{path}/cells")
        self.labels.write.mode("overwrite").parquet(f"{path}/labels")


def statistics(instances: DataFrame, docs: DataFrame) -> Statistics:
    """Of counted instances ``(doc_id, label, feature, value)``, a feature once a document,
    and ``docs (doc_id, label)``, those without a feature too. Counts fold before the shuffle."""
    return Statistics(instances.groupBy("label", "feature", "value").agg(F.count(F.lit(1)).alias("n")),
                      docs.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs")))


def load_statistics(spark: SparkSession, paths: list[str]) -> Statistics:
    """The days under ``paths`` (at least one), added up."""
    return merged([Statistics(spark.read.parquet(f"{p}/cells"), spark.read.parquet(f"{p}/labels")) for p in paths])


def merged(days: list[Statistics]) -> Statistics:
    cells, labels = [reduce(DataFrame.unionByName, x) for x in ([d.cells for d in days], [d.labels for d in days])]
    return Statistics(cells.groupBy("label", "feature", "value").agg(F.sum("n").alias("n")),
                      labels.groupBy("label").agg(F.sum("n_docs").alias("n_docs")))


def vocabulary_of(stats: Statistics, min_count: int = MIN_COUNT) -> DataFrame:
    """``(feature, fid, cnt)``."""
    return numbered_features(stats.cells.groupBy("feature").agg(F.sum("n").alias("cnt")), min_count)


def _indexed(stats: Statistics, vocab: DataFrame) -> DataFrame:
    cells = stats.cells.withColumnRenamed("feature", "token")
    met = join_vocabulary(cells, vocab.select(F.col("feature").alias("token"), "fid"))
    return met.select("label", (F.col("fid") - 1).alias("fidx"), "value", "n")


def idf_of(stats: Statistics, vocab: DataFrame) -> DataFrame:
    """A3, A4: ``(fidx, df, idf)`` over all documents of the statistics."""
    n = stats.labels.agg(F.sum("n_docs").cast("double")).scalar()
    per = _indexed(stats, vocab).groupBy("fidx").agg(F.sum("n").alias("df"))
    return per.select("fidx", "df", F.ln(n / F.col("df")).alias("idf"))


def chi_square_of(stats: Statistics, vocab: DataFrame) -> DataFrame:
    """``(fidx, chi2)``."""
    groups = _indexed(stats, vocab).where("value <> 0").withColumnRenamed("n", "o")
    return chi_square_of_groups(groups, stats.labels.select("label", F.col("n_docs").alias("n_l")))


def bayes_of(stats: Statistics, vocab: DataFrame, num_features: int, smoothing: float = DEFAULT_SMOOTHING) -> tuple[DataFrame, DataFrame]:
    """The priors and theta tables."""
    sums = _indexed(stats, vocab).groupBy("label", "fidx").agg(F.sum(F.col("value") * F.col("n")).alias("s_cf"))
    return nb_from_sums(sums, stats.labels, num_features, smoothing)


def grown_dictionary(dictionary: DataFrame, counts: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``(feature, fid)`` of a stored dictionary and, after its last id, of the
    features of ``counts (feature, cnt)`` that reach ``min_count`` and are not in it, most
    frequent first, ties by text. Old ids never change."""
    fresh = counts.where(F.col("cnt") >= min_count).join(dictionary.select("feature"), "feature", "left_anti")
    last = dictionary.agg(F.coalesce(F.max("fid"), F.lit(0)).alias("last")).scalar()
    added = dense_ids(fresh, [F.col("cnt").desc(), F.col("feature").asc()], id_col="fid", start=1)
    return dictionary.select("feature", "fid").unionByName(added.select("feature", (F.col("fid") + last).alias("fid")))
