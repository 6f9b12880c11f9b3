"""Text-based inputs as DataFrames.

Splits of a text scan are sized by ``spark.sql.files.maxPartitionBytes`` (and
``spark.sql.files.minPartitionNum``); no partition count is hard-wired.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions.arrays import explode_rows, posexplode_rows, repeat_rows
from loomtext.functions.hashing import in_sample
from loomtext.functions.text import java_split, java_trim
from loomtext.operators.classify import parse_rule_lines
from loomtext.operators.ids import dense_ids
from loomtext.operators.sampling import FIRST_SALT


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """UTF-8 lines (globs allowed) as ``value``."""
    return spark.read.text(paths)


def numbered_lines(df: DataFrame) -> DataFrame:
    """Lines of a text scan with their order ``ln``: file path, start of the file's
    block, position in it. Splits may be packed into tasks in any order; where "a later
    line wins", file order decides."""
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return df.select("value", F.struct(*meta, F.monotonically_increasing_id().alias("at")).alias("ln"))


def identified_lines(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Lines with an id from their content: the hash of the text and its how-manyeth
    copy. The same lines get the same ids whatever the files, splits and task order;
    equal lines are counted (a partial aggregate) before they are told apart. All lines
    are shuffled once: where a sample is wanted, take it first (:func:`sampled_lines`)."""
    counted = df.groupBy("value").agg(F.count(F.lit(1)).alias("_n"))
    copies = repeat_rows(counted, "_n", "_k")
    return copies.select(F.xxhash64("value", "_k").alias(id_col), "value")


def sampled_lines(df: DataFrame, fraction: float, salt: str = FIRST_SALT) -> DataFrame:
    """R1 on raw lines: a narrow filter on the hash of a line's content, so nothing is
    shuffled for the lines that go. It does not depend on files and splits; equal lines
    are kept or dropped together."""
    return df.where(in_sample(F.xxhash64("value"), fraction, salt))


def read_category_dictionary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``id`name`` lines -> ``(name, category_id)``; fields trimmed; for a repeated
    name the later line wins."""
    lines = numbered_lines(read_lines(spark, path))
    parts = F.split(F.col("value"), "`")
    rows = lines.select("ln", java_trim(F.get(parts, 1)).alias("name"),
                        (java_trim(F.get(parts, 0))).try_cast("int").alias("category_id"))
    rows = rows.where(F.col("name").isNotNull() & F.col("category_id").isNotNull())
    return rows.groupBy("name").agg(F.max_by("category_id", "ln").alias("category_id"))


def read_feature_dictionary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S5 (+F6): ``feature TAB fid`` lines with exactly two fields -> ``(feature, fid)``;
    for a repeated feature the later line wins."""
    lines = numbered_lines(read_lines(spark, path))
    parts = java_split(F.col("value"), "\t")
    rows = lines.where(F.size(parts) == 2).select(
        "ln", F.get(parts, 0).alias("feature"), (F.get(parts, 1)).try_cast("long").alias("fid"))
    return rows.where(F.col("fid").isNotNull()).groupBy("feature").agg(F.max_by("fid", "ln").alias("fid"))


def read_idf_model(spark: SparkSession, path: str) -> DataFrame:
    """``fidx TAB idf`` lines -> ``(fidx, idf)``; for a repeated index the later line
    wins; any other line fails the query."""
    lines = numbered_lines(read_lines(spark, path))
    parts = F.split(F.col("value"), "\t")
    fidx, weight = F.get(parts, 0).try_cast("long"), F.get(parts, 1).try_cast("double")
    bad = (F.size(parts) != 2) | fidx.isNull() | weight.isNull()
    message = F.concat(F.lit("not an idf line: "), F.col("value"))
    rows = lines.select("ln", F.when(bad, F.raise_error(message)).otherwise(fidx).cast("long").alias("fidx"),
                        weight.alias("idf"))
    return rows.groupBy("fidx").agg(F.max_by("idf", "ln").alias("idf"))


def instance_documents(lines: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, label)`` of every instance line with a label, those without any
    feature included (they count as documents)."""
    items = F.filter(F.split(F.col("value"), " "), lambda x: x != "")
    return lines.select(doc_id, F.get(items, 0).alias("label")).where(F.col("label").isNotNull())


def parse_counted_instances(lines: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``label feat:int feat:int ...`` -> ``(doc_id, label, feature, value)``.

    Items are space separated; a feature is split at its *last* ``:`` so feature text
    may contain ``:``; a value that is not an integer gives ``value = null`` (count
    them with ``where(value is null)`` rather than failing the job).
    """
    base = lines if doc_id in lines.columns else lines.withColumn(doc_id, F.monotonically_increasing_id())
    items = base.select(doc_id, F.filter(F.split(F.col("value"), " "), lambda x: x != "").alias("_i"))
    items = items.select(doc_id, F.get(F.col("_i"), 0).alias("label"), "_i")
    ex = posexplode_rows(items, F.col("_i"), "_p", "item", (doc_id, "label")).where(F.col("_p") > 0)
    cut = F.length("item") - F.length(F.substring_index("item", ":", -1))
    return ex.select(doc_id, "label",
                     F.expr("substring(item, 1, greatest(length(item) - length(substring_index(item, ':', -1)) - 1, 0))")
                     .alias("feature"),
                     F.when(cut > 0, (F.substring_index("item", ":", -1)).try_cast("int")).alias("value"))


def parse_libsvm(lines: DataFrame, doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """S2 in long form: libsvm text -> ``(entries, docs)``.

    ``entries = (doc_id, label, fidx, value)`` with ``fidx`` = 1-based index - 1;
    ``docs = (doc_id, label)`` keeps label-only lines. Blank lines and ``#`` comments
    are skipped. Indices must ascend strictly within a line, or the query fails.
    """
    t = java_trim(F.col("value"))
    base = lines.where((t != "") & ~t.startswith("#"))
    if doc_id not in base.columns:
        base = base.withColumn(doc_id, F.monotonically_increasing_id())
    items = base.select(doc_id, F.filter(F.split(java_trim(F.col("value")), r"\s+"), lambda x: x != "").alias("_i"))
    items = items.select(doc_id, F.get(F.col("_i"), 0).cast("double").alias("label"),
                         F.transform(F.slice(F.col("_i"), 2, 1 << 30),
                                     lambda x: F.struct(
                                         (F.substring_index(x, ":", 1).cast("long") - 1).alias("fidx"),
                                         F.substring_index(x, ":", -1).cast("double").alias("value"))).alias("_e"))
    ids = F.transform(F.col("_e"), lambda e: e["fidx"])
    # sort_array is compiled, array_sort compares element by element: only lines with null ids need it
    ok = (F.size(ids) == F.size(F.array_distinct(ids))) & ((F.sort_array(ids) == ids) | (F.array_sort(ids) == ids))
    items = items.withColumn("_e", F.when(ok, F.col("_e")).otherwise(
        F.raise_error(F.concat(F.lit("libsvm indices not strictly ascending in row "), F.col(doc_id).cast("string")))))
    docs = items.select(doc_id, "label")
    entries = explode_rows(items, F.col("_e"), "e", (doc_id, "label")).select(
        doc_id, "label", F.col("e.fidx").alias("fidx"), F.col("e.value").alias("value"))
    return entries, docs


def read_libsvm_vectors(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    """S2 at the ML edge: ``(label, features)`` via the built-in libsvm source; passing
    ``num_features`` spares the extra pass that infers it."""
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)


def read_rule_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rule files ``pattern``tag`` read in the given order -> ``(ord, pattern, tag)``.

    ``ord`` numbers the lines, each file's after those of the files before it; files are
    split and numbered like any other input.
    """
    kept = ("at_file", "ln", "value")
    frames = [numbered_lines(read_lines(spark, p)).withColumn("at_file", F.lit(i)).select(*kept) for i, p in enumerate(paths)]
    lines = reduce(DataFrame.unionByName, frames)
    return parse_rule_lines(dense_ids(lines, [F.col("at_file"), F.col("ln")], id_col="ord", start=0))


__all__ = ["read_lines", "read_category_dictionary", "read_feature_dictionary", "read_idf_model",
           "parse_counted_instances", "parse_libsvm", "read_libsvm_vectors", "read_rule_files", "explode_rows"]
