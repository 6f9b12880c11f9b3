"""Statistics of disjoint inputs add up to those of the whole; a dictionary only grows."""

import random

from conftest import rows
from loomtext.operators import daily
from loomtext.operators.models import nb_tables
from loomtext.operators.select import chi_square
from loomtext.operators.vocab import vocabulary
from loomtext.operators.weights import idf


def corpus(spark):
    rng = random.Random(4)
    docs = [(d, rng.randrange(3)) for d in range(120)]
    data = [(d, label, f"w{w}", rng.randrange(1, 4)) for d, label in docs if d % 11 for w in range(15) if rng.random() < 0.4]
    return (spark.createDataFrame(data, "doc_id long, label int, feature string, value long"),
            spark.createDataFrame(docs, "doc_id long, label int"))


def test_merged_days_equal_the_whole(spark, tmp_path):
    inst, docs = corpus(spark)
    paths = []
    for day in range(2):
        own = [x.where(f"doc_id % 2 = {day}") for x in (inst, docs)]
        paths.append(str(tmp_path / str(day)))
        for _ in range(2):  # a day written again replaces itself
            daily.statistics(*own).save(paths[-1])
    stats = daily.load_statistics(spark, paths)
    voc = vocabulary(inst, 5)
    assert rows(daily.vocabulary_of(stats, 5)) == rows(voc)
    entries = inst.join(voc, "feature").selectExpr("doc_id", "label", "fid", "fid - 1 as fidx", "value")
    close = lambda a, b: [tuple(round(x, 9) for x in r) for r in rows(a)] == [tuple(round(x, 9) for x in r) for r in rows(b)]
    assert close(daily.idf_of(stats, voc), idf(entries, docs))
    assert close(daily.chi_square_of(stats, voc), chi_square(entries, docs))
    for a, b in zip(daily.bayes_of(stats, voc, 15), nb_tables(entries, docs, 15)):
        assert close(a.select(*b.columns), b)


def test_a_dictionary_keeps_its_ids_and_grows(spark):
    old = spark.createDataFrame([("b", 1), ("a", 2), ("gone", 3)], "feature string, fid long")
    counts = spark.createDataFrame([("a", 50), ("z", 40), ("y", 40), ("x", 41), ("few", 2)], "feature string, cnt long")
    got = dict(rows(daily.grown_dictionary(old, counts, 31)))
    assert got == {"b": 1, "a": 2, "gone": 3, "x": 4, "y": 5, "z": 6}
    assert dict(rows(daily.grown_dictionary(old.limit(0), counts, 31))) == {"a": 1, "x": 2, "y": 3, "z": 4}
    assert rows(daily.grown_dictionary(old, counts.limit(0))) == rows(old)
