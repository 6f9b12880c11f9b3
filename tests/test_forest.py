"""The forest against a plain one that makes the same draws."""

import hashlib
import random
from math import ceil, sqrt

import pytest

from loomtext.operators import forest


def bits(text, part=0):
    return int(hashlib.md5(text.encode()).hexdigest()[8 * part: 8 * part + 8], 16)


def data(n=90, features=12, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = rng.randrange(3)
        rows.append((i, label, {f: rng.randrange(1, 60 if f == 2 else 4) for f in range(features) if rng.random() < (0.6 if f % 3 == label else 0.2)}))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, label) for i, label, _ in rows], "doc_id long, label int")
    entries = spark.createDataFrame([(i, label, f, v) for i, label, x in rows for f, v in x.items()],
                                    "doc_id long, label int, fidx long, value long")
    return entries, docs


def plain_forest(rows, trees, depth, bins, seed, features):
    n = len(rows)
    values = {}
    for _, _, x in rows:
        for f, v in x.items():
            values.setdefault(f, []).append(v)
    bin_of, top = {}, {}
    for f, seen in values.items():
        kinds = sorted(set(seen))
        for r, v in enumerate(kinds, 1):
            below = n - len(seen) + sum(s < v for s in seen)
            b = r if len(kinds) < bins else max(1, below * bins // n)
            bin_of[f, v] = b
            top[f, b] = max(top.get((f, b), 0), v)
    take = features if trees == 1 else ceil(sqrt(features))
    splits, leaves = {}, {}
    for t in range(trees):
        where = {}
        for i, label, x in rows:
            times = sum(bits(f"boot{seed}:{t // 4}:{i}", t % 4) >= p for p in forest.POISSON)
            if times:
                where[i] = (1, times, label, {f: bin_of[f, v] for f, v in x.items()})
        for level in range(depth):
            for node in range(1 << level, 2 << level):
                here = [(w, label, x) for k, w, label, x in where.values() if k == node]
                looked = sorted(values, key=lambda f: (bits(f"feat{seed}:{t}:{node}:{f}"), f))[:take]
                whole = gini(here)
                best = None
                for f in sorted(looked):
                    for b in [0, *sorted({x[f] for _, _, x in here if f in x})]:
                        sides = [[r for r in here if (r[2].get(f, 0) > b) == s] for s in (False, True)]
                        if all(sides) and (score := gini(sides[0]) + gini(sides[1])) > whole and (best is None or score > best[0]):
                            best = (score, f, b)
                if best:
                    splits[t, node] = (best[1], top.get(best[1:], 0) if best[2] else 0)
                    where = {i: (2 * k + (x.get(best[1], 0) > best[2]) if k == node else k, w, label, x) for i, (k, w, label, x) in where.items()}
        for k, w, label, _ in where.values():
            leaves.setdefault((t, k), {}).setdefault(label, 0)
            leaves[t, k][label] += w
    return splits, leaves


def gini(rows):
    per = {}
    for w, label, _ in rows:
        per[label] = per.get(label, 0) + w
    return sum(v * v for v in per.values()) / max(1, sum(per.values()))


@pytest.mark.parametrize("trees, depth, bins", [(6, 3, 32), (1, 2, 6)])
def test_forest_matches_a_plain_one(spark, tmp_path, trees, depth, bins):
    rows = data()
    entries, docs = frames(spark, rows)
    model = forest.grow_forest(entries, docs, 12, trees, depth, bins, bootstrap=True)
    splits, leaves = plain_forest(rows, trees, depth, bins, forest.DEFAULT_SEED, 12)
    assert {(r.tree, r.node): (r.fidx, r.threshold) for r in model.splits.collect()} == splits
    votes = {(t, k, label): round(forest.VOTE * w / sum(per.values()) + 1e-9) for (t, k), per in leaves.items() for label, w in per.items()}
    assert {(r.tree, r.node, r.label): r.votes for r in model.leaves.collect()} == votes
    model.save(str(tmp_path / "forest"))
    asked = data(40, seed=8) + [(900, 1, {})]
    got = {r.doc_id: r.prediction for r in forest.predict_forest(forest.load_forest(spark, str(tmp_path / "forest")),
                                                                 *frames(spark, asked), trees, depth).collect()}
    for i, _, x in asked:
        total = {}
        for t in range(trees):
            node = 1
            while (t, node) in splits:
                f, bound = splits[t, node]
                node = 2 * node + (x.get(f, 0) > bound)
            for (tt, k, label), v in votes.items():
                if (tt, k) == (t, node):
                    total[label] = total.get(label, 0) + v
        assert got[i] == min(total, key=lambda label: (-total[label], label))


def test_forest_ignores_the_layout_of_its_rows(spark):
    entries, docs = frames(spark, data())
    one = forest.grow_forest(entries, docs, 12, 4, 2)
    two = forest.grow_forest(entries.repartition(7, "value").sortWithinPartitions("fidx"), docs.orderBy("label").coalesce(1), 12, 4, 2)
    for a, b in ((one.splits, two.splits), (one.leaves, two.leaves)):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_forest_without_entries_or_documents(spark):
    entries, docs = frames(spark, data(6))
    for some in (docs, docs.limit(0)):
        model = forest.grow_forest(entries.limit(0), some, 12, 3, 2)
        assert model.splits.count() == 0
        got = forest.predict_forest(model, entries, docs, 3, 2).collect()
        assert len(got) == docs.count() and len({r.prediction for r in got}) == 1
