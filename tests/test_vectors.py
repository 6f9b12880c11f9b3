import math

import pytest

from pyspark.sql import functions as F

from conftest import rows
from loomtext.functions.text import suffixed_tokens
from loomtext.operators.ids import dense_ids
from loomtext.operators import vectors
from loomtext.operators.vectors import (binary_vectors, count_vectors, counted_instances, distinct_tokens, frequent_tokens,
                                        join_vocabulary, tfidf_vectors, with_term_counts)
from loomtext.operators.vocab import vocabulary
from loomtext.operators.weights import idf
from loomtext.sinks.text import libsvm_lines


def _token_doc(spark):
    # category=0001`url=u`tit=foo 'bar  baz'`kw=q1 q2 q1  ->  0001 foo_1 bar_1 baz_1 q1_2 q2_2 q1_2
    df = spark.createDataFrame([(1, 1, "foo 'bar  baz'", "q1 q2 q1")], "doc_id long, label int, tit string, kw string")
    return df.select("doc_id", "label",
                     F.concat(suffixed_tokens(F.col("tit"), "_1"), suffixed_tokens(F.col("kw"), "_2")).alias("tokens"))


def test_binary_and_tfidf_golden(spark):
    docs = _token_doc(spark)
    vocab = spark.createDataFrame([("foo_1", 3), ("q1_2", 1)], "feature string, fid long")
    w = spark.createDataFrame([(0, 1, 2.0), (2, 1, 0.5)], "fidx long, df long, idf double")
    assert rows(binary_vectors(docs, vocab), "fid", "value") == [(1, 1), (3, 1)]
    tf = {r["fid"]: r["value"] for r in tfidf_vectors(docs, vocab, w).collect()}
    assert math.isclose(tf[1], 2.0 / 6) and math.isclose(tf[3], 0.5 / 6)
    lines = libsvm_lines(tfidf_vectors(docs, vocab, w), docs, value_format="%f").collect()
    assert lines[0]["line"] == "1 1:0.333333 3:0.083333"


def test_term_counts(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b", "c", "b"]), (2, [])], "id int, t array<string>")
    got = {r["id"]: [tuple(x) for x in r["tc"]] for r in with_term_counts(df, "t", "tc").collect()}
    assert got == {1: [("a", 1), ("b", 3), ("c", 1)], 2: []}


def test_idf_golden(spark):
    entries = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (3, 2)], "doc_id long, fid long")
    docs = spark.createDataFrame([(1,), (2,), (3,), (4,)], "doc_id long")
    got = {r["fidx"]: r["idf"] for r in idf(entries, docs).collect()}
    assert math.isclose(got[0], math.log(4 / 3)) and math.isclose(got[1], math.log(4))


def test_vocabulary_threshold(spark):
    data = [(d, 0, "thirty", 5) for d in range(30)] + [(d, 0, "thirtyone", 1) for d in range(31)]
    inst = spark.createDataFrame(data, "doc_id long, label int, feature string, value long")
    assert rows(vocabulary(inst), "feature", "fid", "cnt") == [("thirtyone", 1, 31)]


@pytest.mark.parametrize("bounded", [False, True])
def test_dense_ids_layout_invariant(spark, bounded):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    a = rows(dense_ids(df.repartition(1), [F.col("k").desc()], "i", bounded=bounded), "k", "i")
    b = rows(dense_ids(df.repartition(17), [F.col("k").desc()], "i", bounded=bounded), "k", "i")
    assert a == b
    assert sorted(i for _, i in a) == list(range(1, 5001))
    assert dict(a)[max(k for k, _ in a)] == 1


def test_counted_instances(spark):
    docs = spark.createDataFrame([(1, 0, ["x", "y", "x"])], "doc_id long, label int, tokens array<string>")
    assert rows(counted_instances(docs)) == [(1, 0, "x", 2, 3), (1, 0, "y", 1, 3)]


def _hot_corpus(spark):
    """Every document holds "the"; the other tokens are in a few."""
    data = [(d, d % 2, ["the", "the", f"t{d % 60}", f"u{d % 7}", f"rare{d}"]) for d in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, label int, tokens array<string>")
    vocab = vocabulary(distinct_tokens(docs).withColumnRenamed("token", "feature"), 2)
    return docs, vocab


def test_heavy_light_join_gives_the_rows_of_the_broadcast_one(spark, monkeypatch):
    docs, vocab = _hot_corpus(spark)
    inst = counted_instances(docs)
    w = vocab.select((F.col("fid") - 1).alias("fidx"), (F.lit(1.0) / F.col("cnt")).alias("idf"))
    builders = [lambda n: binary_vectors(docs, vocab, limit=n), lambda n: tfidf_vectors(docs, vocab, w, limit=n),
                lambda n: count_vectors(inst, vocab, limit=n), lambda n: count_vectors(inst, vocab, limit=n, one_row_per_feature=True),
                lambda n: binary_vectors(docs, vocab.drop("cnt"), limit=n)]
    for build in builders:
        whole = rows(build(1 << 30))
        for heavy in (1, 20, 20_000):
            monkeypatch.setattr(join_vocabulary, "__defaults__", (vectors.BROADCAST_BYTES, heavy))
            assert rows(build(0)) == whole


def test_frequent_tokens_are_never_shuffled(spark):
    docs, vocab = _hot_corpus(spark)
    top = frequent_tokens(vocab.withColumnRenamed("feature", "token"), 8)
    names = {r.token for r in top.collect()}
    assert "the" in names and len(names) == 8
    tokens = distinct_tokens(docs)
    rare = tokens.join(top.select("token"), "token", "left_anti").repartition(8, "token")
    sizes = sorted(r["n"] for r in rare.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())
    assert sizes[-1] <= 4 * sizes[len(sizes) // 2]  # with "the" one partition would hold 400 rows more
    plan = join_vocabulary(tokens, vocab.withColumnRenamed("feature", "token"), 0, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "left_anti" in plan.lower().replace("leftanti", "left_anti")


def test_a_missing_weight_fails(spark):
    docs, vocab = _hot_corpus(spark)
    w = vocab.where("fid > 1").select((F.col("fid") - 1).alias("fidx"), F.lit(1.0).alias("idf"))
    with pytest.raises(Exception, match="no idf for feature id 1"):
        tfidf_vectors(docs, vocab, w).collect()


def test_grouped_count_vectors_take_one_exchange(spark):
    """The same entries as the plain form, repeated features summed, after one exchange."""
    from loomtext.operators.vectors import grouped_entries

    inst = spark.createDataFrame([(1, 0, "b", 2), (1, 0, "a", 1), (1, 0, "b", 5), (2, 1, "a", 4), (3, 1, "none", 1)],
                                 "doc_id long, label int, feature string, value int")
    vocab = spark.createDataFrame([("a", 1, 9), ("b", 2, 8)], "feature string, fid long, cnt long")
    grouped = count_vectors(inst, vocab, grouped=True)
    assert rows(grouped_entries(grouped)) == [(1, 0, 0, 1), (1, 0, 1, 7), (2, 1, 0, 4)]
    assert rows(grouped_entries(grouped)) == rows(count_vectors(inst, vocab).selectExpr("doc_id", "label", "fid - 1", "value"))
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1


def test_whole_numbers_need_no_formatter(spark):
    docs = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, label int")
    entries = spark.createDataFrame([(1, 2, 30), (1, 1, 4)], "doc_id long, fid long, value long")
    lines = libsvm_lines(entries, docs)
    assert rows(lines) == [(1, "0 1:4 2:30"), (2, "1 ")]
    assert "format_string" not in lines._jdf.queryExecution().toString()
