import os
import tempfile

from loomtext.operators.classify import rules_frame
from loomtext.plans.jobs import run_labelling
from loomtext.sources.text import read_lines
from loomtext.streaming.labelling import start_labelling
from loomtext.streaming.titles import current_records, start_one_per_title


def test_stream_labels_new_files(spark):
    src = tempfile.mkdtemp(prefix="loomtext-stream-src-")
    out = tempfile.mkdtemp(prefix="loomtext-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="loomtext-stream-ckpt-")
    with open(os.path.join(src, "h00.txt"), "w") as f:
        f.write("url=http://a.example.com/x`tit=A\nurl=http://none.org/`tit=B\n")
    with open(os.path.join(src, "h01.txt"), "w") as f:
        f.write("tit=C`url=http://blog.z.org/\n")
    rules = rules_frame(spark, [(1, ".example.com", "0001"), (2, "blog.", "0002")])
    q = start_labelling(spark, src, rules, out, ckpt, max_files_per_trigger=1, once=True)
    q.awaitTermination(120)
    got = sorted((r["tit"], r["category"]) for r in spark.read.parquet(out).collect())
    assert got == [("A", "0001"), ("C", "0002")]


def _dir(name):
    return tempfile.mkdtemp(prefix=f"loomtext-{name}-")


def _hours(parts):
    src = _dir("hours")
    for i, lines in enumerate(parts):
        with open(os.path.join(src, f"h{i:02}.txt"), "w") as f:
            f.write("".join(line + "\n" for line in lines))
    return src


def _kept(spark, parts, rules, second, per_batch):
    """Title -> line after both streams."""
    labelled, out = _dir("labelled"), _dir("titles")
    start_labelling(spark, _hours(parts), rules, labelled, _dir("c1"), per_batch, once=True).awaitTermination(300)
    start_one_per_title(spark, labelled, out, _dir("c2"), second, per_batch, once=True).awaitTermination(300)
    return out, sorted((r["tit"] or "", r["line"]) for r in current_records(spark, out).collect())


def test_titles_of_a_stream_are_those_of_the_batch_job(spark):
    rules = rules_frame(spark, [(1, ".example.com", "0001"), (2, "blog.", "0002")])
    lines = [f"url=http://h{(i * 7) % 30}.example.com/{i}`tit=t{i % 23}`kw=k" for i in range(200)]
    lines += ["url=http://a.example.com/", "url=http://none.org/`tit=t1", "`tit=t2", "", lines[3]]
    out = _dir("batch")
    run_labelling(spark, _hours([lines]), rules, f"{out}/labelled", f"{out}/sample", 1.0, 0.6)
    want = sorted(r[0] for r in read_lines(spark, f"{out}/sample").collect())
    whole = _kept(spark, [lines], rules, 0.6, 100)[1]
    split = _kept(spark, [lines[i::3] for i in range(3)] + [lines[:50]], rules, 0.6, 1)[1]  # the last hour is a replay
    assert whole == split and 15 < len(whole) <= 24
    assert sorted(line for _, line in whole) == sorted(line.split("`", 1)[1] for line in want)


def test_a_batch_writes_changed_titles_only_and_a_restart_goes_on(spark):
    rules = rules_frame(spark, [(1, "x.", "0001")])
    labelled, out, c1, c2 = _dir("labelled"), _dir("titles"), _dir("c1"), _dir("c2")
    src = _hours([["url=http://x.b/`tit=A", "url=http://x.b/`tit=B"]])

    def run():
        start_labelling(spark, src, rules, labelled, c1, once=True).awaitTermination(300)
        start_one_per_title(spark, labelled, out, c2, 1.0, once=True).awaitTermination(300)

    run()
    with open(os.path.join(src, "h01.txt"), "w") as f:  # A gets a smaller line, B a larger and an equal one
        f.write("url=http://x.a/`tit=A\nurl=http://x.c/`tit=B\nurl=http://x.b/`tit=B\n")
    run()
    written = sorted((r["tit"], r["line"]) for r in spark.read.parquet(out).collect())
    assert written == [("A", "url=http://x.a/`tit=A"), ("A", "url=http://x.b/`tit=A"), ("B", "url=http://x.b/`tit=B")]
    assert {r["tit"]: r["line"][:15] for r in current_records(spark, out).collect()} == {
        "A": "url=http://x.a/", "B": "url=http://x.b/"}
