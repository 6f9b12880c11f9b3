import os
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from loomtext.sinks.text import write_dictionary, write_libsvm, write_lines
from loomtext.sources.text import (identified_lines, instance_documents, parse_counted_instances,
                                   parse_libsvm, read_category_dictionary,
                                   read_feature_dictionary, read_idf_model, read_libsvm_vectors, read_lines,
                                   read_rule_files)


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="loomtext-src-")
    p = os.path.join(d, "part-00000.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_category_dictionary_later_wins(spark):
    p = _write("1`sports\n2 ` news \n7`sports\n")
    assert rows(read_category_dictionary(spark, p)) == [("news", 2), ("sports", 7)]


def test_feature_dictionary_arity(spark):
    p = _write("a_1\t3\nbad line\nb_2\t4\textra\nc_1\t5\n")
    assert rows(read_feature_dictionary(spark, p)) == [("a_1", 3), ("c_1", 5)]


def test_idf_model(spark):
    p = _write("0\t0.5\n2\t1.25\n")
    assert rows(read_idf_model(spark, p)) == [(0, 0.5), (2, 1.25)]


def test_counted_instances_parse(spark):
    lines = spark.createDataFrame([(1, "0001 a:2 b:x:3 c:oops"), (2, "0002")], "doc_id long, value string")
    got = rows(parse_counted_instances(lines))
    assert got == [(1, "0001", "a", 2), (1, "0001", "b:x", 3), (1, "0001", "c", None)]


def test_libsvm_round_trip(spark):
    entries = spark.createDataFrame([(1, 2, 1, 1), (1, 2, 4, 3), (2, 0, 2, 5)], "doc_id long, label int, fid long, value long")
    docs = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "doc_id long, label int")
    out = tempfile.mkdtemp(prefix="loomtext-svm-")
    write_libsvm(entries, docs, out)
    lines = read_lines(spark, out)
    assert sorted(r[0] for r in lines.collect()) == ["0 2:5", "1 ", "2 1:1 4:3"]
    e, d = parse_libsvm(lines)
    assert sorted((r["label"], r["fidx"], r["value"]) for r in e.collect()) == [(0.0, 1, 5.0), (2.0, 0, 1.0),
                                                                               (2.0, 3, 3.0)]
    assert d.count() == 3
    vec = read_libsvm_vectors(spark, out, 4).collect()
    assert sorted((r["label"], r["features"].numNonzeros()) for r in vec) == [(0.0, 1), (1.0, 0), (2.0, 2)]


def test_libsvm_rejects_unsorted(spark):
    lines = spark.createDataFrame([("1 3:1 2:1",)], "value string")
    e, _ = parse_libsvm(lines)
    try:
        e.collect()
        raise AssertionError("expected failure")
    except Exception as ex:  # noqa: BLE001
        assert "ascending" in str(ex)


def test_rule_files_order(spark):
    a = _write(".x.com``0001\nnot a rule\nblog.``0002\n")
    b = _write(".y.com``0003 \n")
    got = [(r["pattern"], r["tag"]) for r in read_rule_files(spark, [a, b]).orderBy("ord").collect()]
    assert got == [(".x.com", "0001"), ("blog.", "0002"), (".y.com", "0003 ")]


def test_dictionary_sink(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "feature string, fid long")
    out = tempfile.mkdtemp(prefix="loomtext-dict-")
    write_dictionary(df, out, ("feature", "fid"), "fid", single_file=True)
    files = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(files) == 1
    assert rows(read_feature_dictionary(spark, os.path.join(out, files[0]))) == [("a", 1), ("b", 2)]
    big = spark.range(1, 2001).selectExpr("concat('f', id) AS feature", "id AS fid").repartition(7)
    write_dictionary(big, out + "-big", ("feature", "fid"), "fid")
    parts = sorted(f for f in os.listdir(out + "-big") if f.startswith("part-"))
    ids = [int(line.split("\t")[1]) for f in parts for line in open(os.path.join(out + "-big", f))]
    assert ids == list(range(1, 2001))
    write_lines(df.select(F.concat_ws("=", "feature", "fid").alias("line")), out + "-lines")
    assert sorted(r[0] for r in read_lines(spark, out + "-lines").collect()) == ["a=1", "b=2"]


def test_later_file_wins_whatever_the_sizes(spark):
    d = tempfile.mkdtemp(prefix="loomtext-two-")
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("1`sports\n")
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write("9`other\n" * 500 + "2`sports\n")
    assert ("sports", 2) in rows(read_category_dictionary(spark, d))


def test_idf_model_later_wins_and_bad_lines_fail(spark):
    assert rows(read_idf_model(spark, _write("0\t0.5\n0\t0.75\n"))) == [(0, 0.75)]
    try:
        read_idf_model(spark, _write("0\t0.5\nnonsense\n")).collect()
        raise AssertionError("expected failure")
    except Exception as ex:  # noqa: BLE001
        assert "not an idf line" in str(ex)


def test_dictionary_keeps_quotes(spark):
    df = spark.createDataFrame([('"hello', 1), ("a\\b", 2), ("c,d", 3)], "feature string, fid long")
    out = tempfile.mkdtemp(prefix="loomtext-quotes-")
    write_dictionary(df, out, ("feature", "fid"), "fid")
    assert rows(read_feature_dictionary(spark, out)) == sorted([('"hello', 1), ("a\\b", 2), ("c,d", 3)])


def test_label_only_lines_are_documents(spark):
    lines = identified_lines(spark.createDataFrame([("x a:1",), ("y",), ("y",), ("",)], "value string"))
    docs = instance_documents(lines).collect()
    assert sorted(r["label"] for r in docs) == ["x", "y", "y"] and len({r["doc_id"] for r in docs}) == 3
