import os
import tempfile

import pytest

from loomtext.operators.classify import rules_frame
from loomtext.plans import jobs
from loomtext.plans.stages import Stages
from loomtext.sources.text import read_lines, sampled_lines


def _file(text: str) -> str:
    d = tempfile.mkdtemp(prefix="loomtext-job-")
    p = os.path.join(d, "part-00000")
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_labelling_then_formatting(spark):
    logs = _file("url=http://a.example.com/1`tit=red car`kw=car\n"
                 "url=http://b.example.com/2`tit=red car`kw=auto\n"
                 "url=http://z.org/blog.html`tit=blue sky`kw=sky blue\n"
                 "url=http://none.org/`tit=nothing\n")
    rules = rules_frame(spark, [(1, ".example.com", "0001"), (2, "blog.", "0002")])
    out = tempfile.mkdtemp(prefix="loomtext-lab-")
    jobs.run_labelling(spark, logs, rules, f"{out}/labelled", f"{out}/sample", first=1.0, second=1.0)
    assert spark.read.parquet(f"{out}/labelled").count() == 3
    sample = sorted(r[0] for r in read_lines(spark, f"{out}/sample").collect())
    assert len(sample) == 2 and all(s.startswith("category=000") for s in sample)

    dictionary = _file("red_1\t1\ncar_1\t2\nsky_2\t3\n")
    jobs.run_binary_libsvm(spark, f"{out}/sample", dictionary, f"{out}/binary")
    lines = sorted(r[0] for r in read_lines(spark, f"{out}/binary").collect())
    assert lines == ["1 1:1 2:1", "2 3:1"]
    jobs.run_idf(spark, f"{out}/binary", f"{out}/idf")
    jobs.run_tfidf_libsvm(spark, f"{out}/sample", dictionary, f"{out}/idf", f"{out}/tfidf")
    assert read_lines(spark, f"{out}/tfidf").count() == 2


def test_training_job(spark):
    cats = _file("0`en\n1`fr\n")
    rows = []
    for i in range(80):
        lab = "en" if i % 2 == 0 else "fr"
        words = ["the", "and"] if lab == "en" else ["le", "et"]
        rows.append(lab + " " + " ".join(f"{w}:{1 + i % 3}" for w in words) + " common:1")
    rows.append("xx unknown:1")
    inst = _file("\n".join(rows) + "\n")
    out = tempfile.mkdtemp(prefix="loomtext-train-")
    res = jobs.run_training(spark, cats, inst, out, model="nb", num_feats=3)
    assert res["nb"].num_features == 3
    assert res["nb"].metrics["test_acc"] == 1.0
    assert os.path.isdir(f"{out}/nb_model") and os.path.isdir(f"{out}/feat_sel_id_map")


def test_word_count_job(spark):
    src = _file("a b\nb\n")
    out = tempfile.mkdtemp(prefix="loomtext-wc-") + "/out"
    jobs.run_word_count(spark, src, out)
    assert sorted(r[0] for r in read_lines(spark, out).collect()) == ["a\t1", "b\t2"]


def test_labelling_does_not_depend_on_splits(spark):
    lines = "".join(f"url=http://h{i % 50}.example.com/{i}`tit=t{i % 90}`kw=k\n" for i in range(3000))
    logs, rules = _file(lines), rules_frame(spark, [(1, ".example.com", "0001"), (2, "h7.", "0002")])
    before, got = spark.conf.get("spark.sql.files.maxPartitionBytes"), []
    try:
        for size in ("134217728", "4096"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            out = tempfile.mkdtemp(prefix="loomtext-split-")
            jobs.run_labelling(spark, logs, rules, f"{out}/labelled", f"{out}/sample", first=0.5, second=0.5)
            got.append(sorted(r[0] for r in read_lines(spark, f"{out}/sample").collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got[0] == got[1] and got[0]


def test_training_keeps_documents_without_features(spark):
    cats = _file("0`en\n1`fr\n")
    rows = ["en the:2"] * 60 + ["fr le:1"] * 60 + ["en"] * 40
    out = tempfile.mkdtemp(prefix="loomtext-empty-")
    jobs.run_training(spark, cats, _file("\n".join(rows) + "\n"), out, model="nb", num_feats=0)
    assert read_lines(spark, f"{out}/url_inst_fm").count() == 160
    assert sorted(r[0] for r in jobs.read_feature_dictionary(spark, f"{out}/feat_id_map").collect()) == ["le", "the"]


def test_the_log_sample_shuffles_nothing(spark):
    logs = _file("".join(f"url=http://h{i}.org/`tit=t{i}\n" for i in range(2000)))
    some = sampled_lines(read_lines(spark, logs), 0.1)
    assert "Exchange" not in some._jdf.queryExecution().executedPlan().toString()
    kept = {r[0] for r in some.collect()}
    assert 120 < len(kept) < 280 and kept == {r[0] for r in sampled_lines(read_lines(spark, logs).repartition(9), 0.1).collect()}


def test_training_with_every_model(spark):
    cats = _file("0`en\n1`fr\n")
    rows = [("en the:2 and:1" if i % 2 else "fr le:1 et:2") + f" w{i % 3}:1" for i in range(150)] + ["fr"]
    out = tempfile.mkdtemp(prefix="loomtext-models-")
    res = jobs.run_training(spark, cats, _file("\n".join(rows) + "\n"), out, model="nb,nb_table,rf", num_feats=0, num_trees=5)
    assert all(r.metrics["test_acc"] == 1.0 and r.num_features == 7 for r in res.values()) and len(res) == 3


def test_a_stopped_training_goes_on_where_it_was(spark, monkeypatch):
    cats = _file("0`en\n1`fr\n")
    text = "en the:2 and:1\nfr le:1 et:2\n" * 60
    inst, keep = _file(text), tempfile.mkdtemp(prefix="loomtext-resume-")
    plain, out = [tempfile.mkdtemp(prefix="loomtext-train-") for _ in range(2)]

    def stop(*a, **k):
        raise RuntimeError("stopped")

    def run(to, folder, **options):
        return jobs.run_training(spark, cats, inst, to, model="nb_table", num_feats=3, resume=folder, **options)

    with monkeypatch.context() as m:
        m.setattr(jobs, "chi_square", stop)
        with pytest.raises(RuntimeError):
            run(out, keep)
    with monkeypatch.context() as m:  # nothing up to the entries is built again
        for name in ("identified_lines", "vocabulary", "count_vectors"):
            m.setattr(jobs, name, stop)
        got = run(out, keep)
        assert got == run(out, keep)
    assert got == run(plain, None)
    for table in ("theta", "pi"):
        a, b = [sorted(map(str, spark.read.parquet(f"{x}/nb_table_model/{table}").collect())) for x in (plain, out)]
        assert a == b and a


def test_stages_of_other_input_or_unfinished_writes_are_not_read(spark):
    src, keep = _file("a\n"), tempfile.mkdtemp(prefix="loomtext-resume-")
    stages = Stages(spark, keep, [src])
    build = lambda: read_lines(spark, src)
    never = lambda: pytest.fail("built again")
    unmarked = build().selectExpr("'old' AS value").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    unmarked.parquet(stages.path("lines", n=1))
    assert [r[0] for r in stages.keep("lines", build, n=1).collect()] == ["a"]  # unfinished: written anew
    assert [r[0] for r in stages.keep("lines", never, n=1).collect()] == ["a"]
    assert Stages(spark, keep, [src]).path("lines", n=1) == stages.path("lines", n=1) != stages.path("lines", n=2)
    with open(src, "w") as f:
        f.write("bb\n")
    assert [r[0] for r in Stages(spark, keep, [src]).keep("lines", build, n=1).collect()] == ["bb"]
