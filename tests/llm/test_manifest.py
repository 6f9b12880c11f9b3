"""The Merkle manifest against a plain tree built in Python."""

import hashlib
import re
import zlib

import pytest

from loomtext.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp string, rank long, node int, digest string, own int, _at int, up int"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def tree(leaves):
    """The root of the leaves and each one's (left, right) siblings."""
    paths, level, under = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        runs = [(level[i: i + 2], under[i: i + 2]) for i in range(0, len(level), 2)]
        for run, below in runs:
            for k, places in enumerate(below):
                for x in places:
                    paths[x].append((run[0] if k else "", run[1] if not k and len(run) > 1 else ""))
        level, under = [h("".join(run)) for run, _ in runs], [sum(below, []) for _, below in runs]
    return level[0], paths


def expected(rows):
    def leaf(r):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    built = []
    for lang in langs:
        members = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built.append((members, *tree([leaf(r) for r in members])))
    root, tops = tree([sub for _, sub, _ in built]) if built else (None, [])
    out = []
    for (members, sub, paths), top in zip(built, tops, strict=True):
        for r, path in zip(members, paths, strict=True):
            steps = path + top
            hit = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            at = leaf((*r[:3], r[3] + 1, r[4]) if hit else r)
            for a, b in steps:
                at = h(a + at + b)
            out.append((r[0], leaf(r), sub, root, h("".join(a + b for a, b in steps)), at, not hit))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


ROWS = [(i if i % 50 else None, f"s{i % 3}" if i % 4 else None, None if i % 17 == 0 else ("en", "de", "aé")[i % 3] if i < 600 else f"l{i}",
         None if i % 5 == 0 else i, None if i % 9 == 0 else "x" * (i % 7) + "é\U0001f600") for i in range(1, 620)]
ROWS += ROWS[:40] + ROWS[3:4] * 30 + [(9001, "s", "en", 5, "long " * 200_000), (9001, "s", "en", 5, ""), (-3, "", "", 0, "")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2, "no", 3, 4, 5) for r in rows], SCHEMA)


@pytest.mark.parametrize("digits", [8, 2])
def test_manifest_matches_plain_trees(spark, digits):
    got = manifest.merkle_manifest(frame(spark, ROWS), digits=digits).drop("path")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert order(map(tuple, got.collect())) == order(expected(ROWS))


def test_small_tables(spark):
    for rows in ([], ROWS[:1], ROWS[:2], [(None, None, None, None, None)] * 3, [(7, None, None, None, None)]):
        got = manifest.merkle_manifest(frame(spark, rows)).drop("path")
        assert order(map(tuple, got.collect())) == order(expected(rows))


def test_path_verifies_and_breaks(spark):
    out = manifest.merkle_manifest(frame(spark, ROWS)).collect()
    for r in out:
        at = r.leaf
        for s in r.path:
            at = h(s.left + at + s.right)
        assert at == r.root
    assert {r.verified for r in out} == {True, False}


def test_one_exchange_and_one_sort_roll_up_a_block(spark):
    nodes = spark.range(3000).selectExpr("id % 3 as grp", "id div 3 as rank", "1000L + id % 3 as n", "string(id) as digest", "struct(id) as own")
    plan = manifest.roll_up(nodes)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert len(re.findall(r"\bSort \[", plan)) <= 1 and "Join" not in plan
