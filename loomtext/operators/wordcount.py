"""A1: word count over text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.functions.text import LINE_BREAK, lines_of_parts, whitespace_words
from loomtext.functions.arrays import explode_rows


def word_count(lines: DataFrame, value: str = "value") -> DataFrame:
    """Count each ``\\s+``-separated word of every line: ``(word, cnt)``.

    The explode is narrow; the count is a partial (map-side) aggregate followed by one
    shuffle on ``word``, so a very common word is combined per partition first.
    """
    words = explode_rows(lines, whitespace_words(F.col(value)), "word")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def blob_lines(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line of a text column (a text-file scan of each blob).

    The split pieces are a column of their own, so the blob is split once, not once
    per reference in the empty / trailing-terminator cases."""
    parts = df.select(*keep, F.split(F.col(text), LINE_BREAK).alias("_parts"))
    return explode_rows(parts, lines_of_parts(F.col("_parts")), "value", keep)
