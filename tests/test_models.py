import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from loomtext.operators.bayes import Bayes, load_bayes, predict_bayes
from loomtext.operators.evaluate import holdout_metrics
from loomtext.operators.models import fit_naive_bayes, nb_tables, to_vectors
from loomtext.operators.select import chi_square, reindex, top_features


def test_chi_square_golden(spark):
    labels, values = [0, 0, 1, 1, 1, 2], [2, 0, 0, 0, 0, 7]
    docs = spark.createDataFrame([(i, lab) for i, lab in enumerate(labels)], "doc_id long, label int")
    entries = spark.createDataFrame([(i, labels[i], 0, v) for i, v in enumerate(values) if v],
                                    "doc_id long, label int, fidx long, value long")
    got = chi_square(entries, docs).collect()
    assert len(got) == 1 and math.isclose(got[0]["chi2"], 8.25)


def test_chi_square_equals_ml(spark):
    data = [(0, [1, 0, 3]), (0, [1, 2, 0]), (1, [0, 2, 3]), (1, [0, 0, 3]), (2, [5, 2, 0]), (2, [0, 0, 1]),
            (1, [1, 0, 0]), (0, [0, 0, 0])]
    docs = spark.createDataFrame([(i, lab) for i, (lab, _) in enumerate(data)], "doc_id long, label int")
    entries = spark.createDataFrame(
        [(i, lab, j, v) for i, (lab, xs) in enumerate(data) for j, v in enumerate(xs) if v],
        "doc_id long, label int, fidx long, value long")
    ours = {r["fidx"]: r["chi2"] for r in chi_square(entries, docs).collect()}
    vec = spark.createDataFrame([(float(lab), Vectors.dense([float(x) for x in xs])) for lab, xs in data],
                                ["label", "features"])
    ml = ChiSquareTest.test(vec, "features", "label", flatten=True).collect()
    for r in ml:
        assert math.isclose(ours[r["featureIndex"]], r["statistic"], rel_tol=1e-12)


def test_top_features_and_reindex(spark):
    chi = spark.createDataFrame([(5, 1.0), (2, 9.0), (7, 9.0), (1, 3.0)], "fidx long, chi2 double")
    top = top_features(chi, 3)
    assert sorted((r["fidx"], r["new_fidx"]) for r in top.collect()) == [(1, 0), (2, 1), (7, 2)]
    entries = spark.createDataFrame([(1, 0, 7, 4), (1, 0, 5, 1)], "doc_id long, label int, fidx long, value long")
    assert [tuple(r) for r in reindex(entries, top).collect()] == [(1, 0, 2, 4)]


def test_naive_bayes_golden_and_ml(spark):
    # class sizes 2, 3, 1; class 0 feature sums 4, 2, 1, 0 over 4 features
    docs = spark.createDataFrame([(i, lab) for i, lab in enumerate([0, 0, 1, 1, 1, 2])], "doc_id long, label int")
    entries = spark.createDataFrame(
        [(0, 0, 0, 3), (0, 0, 1, 2), (1, 0, 0, 1), (1, 0, 2, 1), (2, 1, 3, 2), (3, 1, 1, 1), (5, 2, 2, 4)],
        "doc_id long, label int, fidx long, value long")
    priors, theta = nb_tables(entries, docs, 4, 0.1)
    pi = {r["label"]: r["pi"] for r in priors.collect()}
    for lab, want in {0: -1.0986123, 1: -0.7091475, 2: -1.7452395}.items():
        assert math.isclose(pi[lab], want, abs_tol=1e-7)
    th0 = {r["fidx"]: r["theta"] for r in theta.where("label = 0").collect()}
    unseen0 = priors.where("label = 0").first()["theta_unseen"]
    for f, want in enumerate([-0.5904930, -1.2595427, -1.9061698, -4.3040651]):
        assert math.isclose(th0.get(f, unseen0), want, abs_tol=1e-7)
    model = fit_naive_bayes(to_vectors(entries, docs, 4), 0.1)
    ml_pi = model.pi.toArray()
    ml_theta = model.theta.toArray()
    for lab in range(3):
        assert math.isclose(ml_pi[lab], pi[lab], rel_tol=1e-12)
    for f in range(4):
        assert math.isclose(ml_theta[0][f], th0.get(f, unseen0), rel_tol=1e-12)


def test_metrics_golden(spark):
    scored = spark.createDataFrame(
        [(0, 1.0, 1.0)] * 2 + [(1, 1.0, 1.0)] * 6 + [(2, 1.0, 0.0)] * 2,
        "n_entries int, label double, prediction double")
    scored = scored.withColumn("n_entries", F.when(F.col("n_entries") == 1, 1).when(F.col("n_entries") == 2, 1)
                               .otherwise(0))
    r = holdout_metrics(scored).first()
    assert (r["total"], r["classified"], r["errors"]) == (10, 8, 2)
    assert r["test_err"] == pytest.approx(0.25) and r["test_acc"] == pytest.approx(0.75)
    assert r["test_rec"] == pytest.approx(0.6) and r["f1"] == pytest.approx(0.666667, abs=1e-6)


def test_sparse_vectors_and_bayes_on_tables(spark, tmp_path):
    """A feature space of a million: vectors cost their entries; tables give the learner's answers."""
    width = 1_000_000
    data = [(d, d % 3, (d * 7919 + 31 * k * (d % 3 + 1)) % 40 * 20_000 + d % 3, 1 + k) for d in range(90) for k in range(4)]
    entries = spark.createDataFrame(data, "doc_id long, label int, fidx long, value long").groupBy("doc_id", "label", "fidx") \
        .agg(F.sum("value").alias("value"))
    docs = entries.select("doc_id", "label").distinct().unionByName(spark.createDataFrame([(900, 1)], "doc_id long, label int"))
    vectors = to_vectors(entries, docs, width)
    got = {r.doc_id: r for r in vectors.collect()}
    for r in entries.collect():
        assert got[r.doc_id].features[r.fidx] == r.value
    assert got[900].n_entries == 0 and got[900].features.numNonzeros() == 0
    assert all(r.features.size == width and len(r.features.indices) == r.n_entries for r in got.values())
    Bayes(*nb_tables(entries, docs, width)).save(str(tmp_path / "nb"))
    ours = predict_bayes(load_bayes(spark, str(tmp_path / "nb")), entries, docs)
    theirs = fit_naive_bayes(vectors).transform(vectors)
    assert {r.doc_id: (r.n_entries, r.prediction) for r in ours.collect()} == \
        {r.doc_id: (r.n_entries, int(r.prediction)) for r in theirs.collect()}


def test_class_sums_and_selected_entries_are_stored(spark):
    """Both tables of a model read one stored aggregate, both splits one stored selection."""
    from loomtext.plans import catalog

    docs = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, label int")
    entries = spark.createDataFrame([(1, 0, 0, 2), (2, 1, 1, 3)], "doc_id long, label int, fidx long, value long")
    for t in nb_tables(entries, docs, 2):
        assert any("class-sums" in f for f in t.inputFiles())
    _, train_e, _, test_e, _ = catalog._split_sets(spark, "/root/testdata/sf0.001")
    assert all("selected-entries" in f for e in (train_e, test_e) for f in e.inputFiles())


def test_bayes_of_many_classes_meets_one_row_a_block(spark):
    from loomtext.operators.bayes import BLOCK, score_classes

    classes = 2 * BLOCK + 3
    docs = [(d, d % classes) for d in range(3 * classes)]
    entries = [(d, c, (d * 7 + k) % 9, 1 + k) for d, c in docs[:-2] for k in range(3)]
    docs_df = spark.createDataFrame(docs, "doc_id long, label int")
    entries_df = spark.createDataFrame(entries, "doc_id long, label int, fidx long, value long")
    model = Bayes(*nb_tables(entries_df, docs_df, 9))
    pi = {r.label: (r.pi, r.theta_unseen) for r in model.priors.collect()}
    theta = {(r.label, r.fidx): r.theta for r in model.theta.collect()}
    scored = score_classes(model, entries_df, docs_df)
    held = [f for f in scored.inputFiles() if "bayes-gains" in f]
    assert held and spark.read.parquet(*held).count() <= 9 * 3
    got = {(r["doc_id"], r["class"]): r["score"] for r in scored.collect()}
    assert len(got) == len(docs) * classes
    for (d, c), score in got.items():
        want = pi[c][0] + sum(v * theta.get((c, f), pi[c][1]) for e, _, f, v in entries if e == d)
        assert abs(score - want) < 1e-9
