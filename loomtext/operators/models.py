"""Naive Bayes as tables, and Spark ML training at the edge.

Naive Bayes (multinomial, smoothing s, C classes, F features)::

    pi_c     = ln(n_c + s) - ln(N + C s)
    theta_cf = ln(S_cf + s) - ln(S_c + F s)

``S_cf`` is the value sum of feature f in class c and ``S_c`` its sum over features.
Only observed (c, f) pairs are stored; every other pair has ``theta_unseen_c`` =
``ln(s) - ln(S_c + F s)``, kept on the class row. These equal ``ml.NaiveBayes``.

Vectors exist only at the ML edge: long entries are grouped per document into the indices
and values of a sparse vector, so a document costs what its entries cost, whatever the
width of the feature space.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from loomtext.operators.sizing import broadcast_if_small
from loomtext.session import reliable_checkpoint, scratch_path

DEFAULT_SMOOTHING = 0.1
DEFAULT_TREES, DEFAULT_DEPTH, DEFAULT_BINS = 100, 4, 32


def nb_tables(entries: DataFrame, docs: DataFrame, num_features: int,
              smoothing: float = DEFAULT_SMOOTHING) -> tuple[DataFrame, DataFrame]:
    """A9 + M6 as tables: ``priors(label, n_docs, pi, theta_unseen)`` and
    ``theta(label, fidx, theta)`` for observed pairs."""
    per_class = docs.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"))
    # one row an observed pair, stored: both tables read it
    sums = reliable_checkpoint(entries.groupBy("label", "fidx").agg(F.sum("value").alias("s_cf")), "class-sums")
    return nb_from_sums(sums, per_class, num_features, smoothing)


def nb_from_sums(sums: DataFrame, per_class: DataFrame, num_features: int,
                 smoothing: float = DEFAULT_SMOOTHING) -> tuple[DataFrame, DataFrame]:
    """The tables of ``(label, fidx, s_cf)`` and ``(label, n_docs)``."""
    s = float(smoothing)
    class_sums = sums.groupBy("label").agg(F.sum("s_cf").alias("s_c"))
    totals = per_class.agg(F.sum("n_docs").cast("double").alias("n"), F.count(F.lit(1)).alias("c"))
    n_all, n_classes = totals.select("n").scalar(), totals.select("c").scalar()
    classes = per_class.join(class_sums, "label", "left").withColumn("s_c", F.coalesce("s_c", F.lit(0)))
    denom = F.ln(F.col("s_c").cast("double") + F.lit(num_features * s))
    priors = classes.select(
        "label", "n_docs",
        (F.ln(F.col("n_docs") + F.lit(s)) - F.ln(n_all + n_classes * F.lit(s))).alias("pi"),
        (F.lit(math.log(s)) - denom).alias("theta_unseen"))
    den = broadcast_if_small(classes.select("label", denom.alias("_den")))
    theta = sums.join(den, "label").select(
        "label", "fidx", (F.ln(F.col("s_cf").cast("double") + F.lit(s)) - F.col("_den")).alias("theta"))
    return priors, theta


SPARSE = 0  # how the vector type marks a sparse vector


def to_vectors(entries: DataFrame, docs: DataFrame, num_features: int) -> DataFrame:
    """``(doc_id, label double, n_entries, features vector)`` for every document of
    ``docs``, stored (the learners pass over it several times); one shuffle on ``doc_id``
    groups the entries of a document. The sparse vectors are written as the plain structs
    that they are and read back under their type, all on the JVM."""
    pair = F.struct(F.col("fidx").cast("int").alias("i"), F.col("value").cast("double").alias("v"))
    grouped = entries.groupBy("doc_id").agg(F.sort_array(F.collect_list(pair)).alias("_e"))
    full = docs.select("doc_id", "label").join(grouped, "doc_id", "left")
    held = F.coalesce("_e", F.array().cast("array<struct<i:int,v:double>>"))
    vector = F.struct(F.lit(SPARSE).cast("tinyint").alias("type"), F.lit(int(num_features)).alias("size"),
                      F.transform(held, lambda e: e["i"]).alias("indices"), F.transform(held, lambda e: e["v"]).alias("values"))
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "vectors")
    full.select("doc_id", F.col("label").cast("double").alias("label"), F.size(held).alias("n_entries"),
                vector.alias("features")).write.parquet(path)
    kinds = [StructField("doc_id", docs.schema["doc_id"].dataType), StructField("label", DoubleType()),
             StructField("n_entries", IntegerType()), StructField("features", VectorUDT())]
    return spark.read.schema(StructType(kinds)).parquet(path)


def fit_naive_bayes(vectors: DataFrame, smoothing: float = DEFAULT_SMOOTHING):
    """M6: multinomial naive Bayes (``ml.NaiveBayes``)."""
    return NaiveBayes(smoothing=smoothing, modelType="multinomial", labelCol="label",
                      featuresCol="features").fit(vectors)


def fit_random_forest(vectors: DataFrame, num_trees: int = DEFAULT_TREES, max_depth: int = DEFAULT_DEPTH,
                      max_bins: int = DEFAULT_BINS, seed: int = 7, bootstrap: bool = True, subsets: str = "auto"):
    """M5: gini random forest, every feature continuous, ``auto`` feature subsets. ``operators/forest.py`` grows
    forests that do not depend on the layout of their rows."""
    return RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins, impurity="gini",
                                  featureSubsetStrategy=subsets, bootstrap=bootstrap, seed=seed, labelCol="label",
                                  featuresCol="features").fit(vectors)


def predict(model, vectors: DataFrame) -> DataFrame:
    """M7: ``(doc_id, label, prediction)``."""
    return model.transform(vectors).select("doc_id", "label", "prediction")


def save_model(model, path: str) -> None:
    """K5: write a fitted model (overwrite)."""
    model.write().overwrite().save(path)
