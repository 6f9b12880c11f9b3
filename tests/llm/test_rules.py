"""Quality rules: base counts by regular expressions, trees by a plain walk."""

import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF_ORACLE

from loomtext.llm import queries, rules

SCHEMA = "doc_id long, text string, score string, kept int, x int, id string, hash int, n_words string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    runs = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def texts():
    rng = random.Random(5)
    some = ["a", "b", "c", "é", "𝒳y", "#", "<b>", " ", "\x1c", " x"]
    out = [None, "", " \t\x0b\x0c\r\n", "#*", "a", "x " * 9, "x " * 10, "a b c d e " * 3, "same\nsame\n same\n\n \n", "w" * 100_000, "　"]
    out += ["".join(rng.choice(some) + rng.choice([" ", "\n", "\t", "  ", "\r\n"]) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    return out


@pytest.fixture(scope="module")
def learnt(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    return docs, spark.read.parquet(f"{SF_ORACLE}/labels.parquet")


def test_base_counts(spark, learnt):
    rows = [(i % 90 if i % 40 else None, t, "clash", 7, 1, "z", 2, "n") for i, t in enumerate(texts())]
    rows += rows[:20] + [(5000, " ".join(str(i % 700) for i in range(30_000)), "", 0, 0, "", 0, "")]
    got = rules.quality_rules(spark.createDataFrame(rows, SCHEMA), learnt[1])
    assert got.columns == ["doc_id", *rules.COUNTS, "base_failed", "score", "kept"]
    found = sorted((tuple(r[:7]) for r in got.collect()), key=str)
    want = []
    for i, text, *_ in rows:
        c = brute(text) if i != 5000 else (30_000, len(text.replace(" ", "")), 0, 0, 30_000)
        want.append((i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert found == sorted(want, key=str)
    assert not any(r.kept for r in got.collect() if r.base_failed)
    assert rules.quality_rules(spark.createDataFrame([], SCHEMA), learnt[1]).count() == 0


def test_trees_fall_with_the_falling_shares():
    rng = np.random.default_rng(3)
    x = rng.random((3000, len(rules.FEATURES)))
    y = ((x[:, 0] * x[:, 8] + 0.4 * np.sin(9 * x[:, 2]) + 0.2 * rng.normal(size=3000)) < 0.4).astype(float)
    model = rules.fit(x, y)
    assert len(model.roots) == rules.TREES and len(model.feature) > 3 * rules.TREES
    for f in range(len(rules.FALLING)):
        probe = np.repeat(x[:60], 40, axis=0)
        probe[:, f] = np.tile(np.linspace(0, 1, 40), 60)
        steps = np.diff(model.probability(probe).reshape(60, 40), axis=1)
        assert (steps <= 1e-12).all()
    free = rules.fit(x, y, signs=np.zeros(len(rules.FEATURES), int))
    probe = np.repeat(x[:60], 40, axis=0)
    probe[:, 2] = np.tile(np.linspace(0, 1, 40), 60)
    assert (np.diff(free.probability(probe).reshape(60, 40), axis=1) > 1e-6).any()  # the constraint does bind


def test_flat_arrays_match_a_plain_walk():
    rng = np.random.default_rng(4)
    x = rng.random((500, len(rules.FEATURES)))
    m = rules.fit(x, (x[:, 1] + x[:, 9] > 1).astype(float))

    def walk(row):
        total = m.base
        for k in m.roots:
            while m.feature[k] >= 0:
                k = m.right[k] if row[m.feature[k]] > m.threshold[k] else m.left[k]
            total += m.value[k]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(m.probability(x[:50]), [walk(r) for r in x[:50]])
    assert len(m.probability(x[:0])) == 0


def test_held_out_documents(spark, learnt):
    docs, labels = learnt
    got = {r.doc_id: r for r in queries.op12_quality_rules(spark, SF_ORACLE).collect()}
    assert len(got) == docs.count()
    known = [(got[r.doc_id], r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id in got]
    right = [(r.score >= rules.KEEP) == (q == 1) for r, q in known]
    assert len(right) > 40 and np.mean(right) > 0.9


def test_labels_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, None)], "doc_id long, text string")
    for marks in ([], [(2, 1), (3, None), (None, 0)]):
        labels = spark.createDataFrame(marks, "doc_id long, quality int")
        assert [tuple(r)[-3:] for r in rules.quality_rules(docs, labels).orderBy("doc_id").collect()][1][0] is True
