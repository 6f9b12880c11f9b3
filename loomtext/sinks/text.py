"""K1-K5: text, libsvm, dictionary and table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def libsvm_lines(entries: DataFrame, docs: DataFrame, value_format: str = "%d", fid: str = "fid") -> DataFrame:
    """K2 (+O2): ``(doc_id, line)``, ``line = "label fid:val fid:val ..."`` with
    ascending ids (``sort_array`` inside the row); a document without entries keeps
    ``"label "``.

    ``value_format`` is ``%d`` for counts, ``%f`` for weights (6 decimals). One
    shuffle on ``doc_id`` gathers a document's entries.
    """
    grouped = entries.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col(fid).alias("i"), F.col("value").alias("v")))).alias("_e"))
    return grouped_libsvm_lines(grouped, docs, value_format)


def grouped_libsvm_lines(grouped: DataFrame, docs: DataFrame, value_format: str = "%d") -> DataFrame:
    """:func:`libsvm_lines` of ``(doc_id, _e)``, the sorted ``(i, v)`` entries of each document."""
    whole = value_format == "%d" and isinstance(grouped.schema["_e"].dataType.elementType["v"].dataType, IntegralType)
    value = (lambda x: x["v"].cast("string")) if whole else (lambda x: F.format_string(value_format, x["v"]))
    pairs = F.array_join(F.transform(F.col("_e"), lambda x: F.concat(
        x["i"].cast("string"), F.lit(":"), F.coalesce(value(x), F.lit("null")))), " ")
    full = docs.select("doc_id", "label").join(grouped, "doc_id", "left")
    return full.select("doc_id", F.concat(F.col("label").cast("string"), F.lit(" "),
                                          F.coalesce(pairs, F.lit(""))).alias("line"))


def write_lines(df: DataFrame, path: str, column: str = "line") -> None:
    """K1: one text line per row."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_libsvm(entries: DataFrame, docs: DataFrame, path: str, value_format: str = "%d") -> None:
    """K2 to files: libsvm text, one document per line."""
    write_lines(libsvm_lines(entries, docs, value_format), path)


def write_dictionary(df: DataFrame, path: str, cols: tuple[str, str], order: str, single_file: bool = False) -> None:
    """K3 (+O3): a two-column mapping as tab-separated text sorted by ``order``.

    The global sort range-partitions the rows, so the part files hold consecutive id
    ranges in name order and no task sees the whole mapping. ``single_file=True``
    gives the reference's one file; use it only for mappings of bounded size (a
    selection map of k rows), as one task then writes everything.
    """
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    out = df.orderBy(order).select(line.alias("line"))  # plain text: no quoting, a reader splits at tabs
    if single_file:
        out = out.coalesce(1)
    write_lines(out, path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K4: a long table as Parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
