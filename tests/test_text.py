from pyspark.sql import functions as F

from conftest import rows
from loomtext.functions.text import java_split, java_trim, suffixed_tokens, text_lines
from loomtext.operators.wordcount import blob_lines, word_count


def test_word_count_golden(spark):
    lines = spark.createDataFrame([("a b",), ("  a",), ("",), ("   ",), ("b  ",)], "value string")
    got = dict(rows(word_count(lines)))
    assert got == {"a": 2, "b": 2, "": 2}


def test_java_split_semantics(spark):
    df = spark.createDataFrame([("a-b-c",), ("a-b--",), ("",), ("---",), ("-x",)], "s string")
    got = dict((r[0], r[1]) for r in df.select("s", java_split(F.col("s"), "-").alias("p")).collect())
    assert got == {"a-b-c": ["a", "b", "c"], "a-b--": ["a", "b"], "": [""], "---": [], "-x": ["", "x"]}


def test_java_trim_removes_control_chars(spark):
    df = spark.createDataFrame([("\t x \n",), ("  ",)], "s string")
    assert rows(df.select(java_trim("s"))) == [("",), ("x",)]


def test_text_lines(spark):
    df = spark.createDataFrame([(1, "a\nb\n"), (2, ""), (3, "x\r\ny\rz")], "id int, text string")
    got = {r[0]: r[1] for r in df.select("id", text_lines(F.col("text"))).collect()}
    assert got == {1: ["a", "b"], 2: [], 3: ["x", "y", "z"]}
    assert blob_lines(df, "text", ("id",)).count() == 5


def test_suffixed_tokens(spark):
    df = spark.createDataFrame([("foo 'bar  baz'",), (None,)], "t string")
    got = [r[0] for r in df.select(suffixed_tokens(F.col("t"), "_1")).collect()]
    assert sorted(map(tuple, got)) == [(), ("foo_1", "bar_1", "baz_1")]
