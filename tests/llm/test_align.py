"""Alignment of two tokenizers against a plain walk, and the algebra of its fragments."""

import hashlib
import random
from collections import Counter
from functools import reduce

import numpy as np
import pytest
import sentencepiece
from conftest import SF_ORACLE
from tokenizers import Tokenizer

from loomtext.llm import align, queries

SCHEMA = "doc_id long, text string, key int, id string, part int, pairs string, up int, docs int"


@pytest.fixture(scope="module")
def plain():
    """(encode by the named libraries, bytes of a token): independent of the operator."""
    a = Tokenizer.from_file(f"{align.FOLDER}/{align.BYTE_BPE}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{align.FOLDER}/{align.PIECE_BPE}")
    of = align._byte_of()

    def encode(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        left = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in ids]
        right = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            right.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
        data = b" " + text.encode()
        return (left, right) if b"".join(x for _, x in left) == data == b"".join(x for _, x in right) else None

    return encode


@pytest.fixture(scope="module")
def tools():
    return align.Tokenizers(*[open(f"{align.FOLDER}/{n}", "rb").read() for n in (align.BYTE_BPE, align.PIECE_BPE)])


def walk(pair):
    """(n_a, n_b, groups text, links) by one pointer on each side."""
    spans = []
    for side in pair:
        at, out = 0, []
        for i, data in side:
            out.append((i, at, at + len(data)))
            at += len(data)
        spans.append(out)
    a, b = spans
    links, k = [], 0
    for i, low, high in a:
        while b[k][2] <= low:
            k += 1
        j = k
        while j < len(b) and b[j][1] < high:
            links.append((i, b[j][0]))
            j += 1
    groups, m, n = [], 0, 0
    for cut in sorted({x[2] for x in a} & {x[2] for x in b}):
        left, right = [], []
        while m < len(a) and a[m][2] <= cut:
            left.append(str(a[m][0]))
            m += 1
        while n < len(b) and b[n][2] <= cut:
            right.append(str(b[n][0]))
            n += 1
        groups.append(",".join(left) + "|" + ",".join(right))
    return len(a), len(b), groups, links


def expected(rows, encode):
    walked = [walk(p) if t and (p := encode(t)) else (0, 0, [], []) for _, t in rows]
    docs = Counter(x for w in walked for x in set(w[3]))
    best = {}
    for (a, _), n in docs.items():
        best[a] = max(best.get(a, 0), n)
    return [(i, n_a, n_b, len(groups), len(links), sum(docs[x] == best[x[0]] for x in links), sum(docs[x] for x in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for (i, _), (n_a, n_b, groups, links) in zip(rows, walked, strict=True)]


def texts():
    rng = random.Random(9)
    some = ["the", "quick", "Übergröße", "naïve", "人工智能", "1234567", "'re", "<|endoftext|>", "</s>", "\n", "\t\t", "  ", "é", "🙂🙃",
            "x" * 30, "▁", "\x00", "don't", "…", " ", "　"]
    out = [None, "", " ", "   ", "\n", "a", " a", "a ", "▁x", "<s>", "<0x41>"]
    out += ["".join(rng.choice(some) + rng.choice([" ", "", "", "\n", "  "]) for _ in range(rng.randrange(1, 40))) for _ in range(120)]
    out += [" ".join(rng.choice(some[:8]) for _ in range(2500)) for _ in range(3)]
    return out + ["人工智能的发展" * 700, "word " * 300 + "x" * 3000 + " end " * 50, "a  b   c\n\nd " * 300]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "z", 2, "p", 3, 4) for r in rows], SCHEMA)


@pytest.mark.parametrize("range_bytes, hot", [(1 << 16, 1 << 19), (500, 40)])
def test_alignment_matches_a_plain_walk(spark, plain, range_bytes, hot):
    rows = [(i if i % 30 else None, t) for i, t in enumerate(texts())]
    rows += rows[5:25] + [(7, "another text of an id")]
    got = align.align(frame(spark, rows), range_bytes=range_bytes, hot_pairs=hot)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected(rows, plain), key=str)


def test_small_tables(spark, plain):
    for rows in ([], [(None, None)], [(1, "one text"), (1, "one text")]):
        assert sorted(map(tuple, align.align(frame(spark, rows)).collect()), key=str) == sorted(expected(rows, plain), key=str)


def test_the_query_on_whole_documents(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r) for r in queries.op13_tokenizer_alignment(spark, SF_ORACLE).collect()}
    assert len(got) == len(rows)
    for want in expected(rows, plain):
        assert got[want[0]] == want


def token_run(rng, n):
    ends = sorted(rng.sample(range(1, n), n // 3)) + [n]
    return np.array([rng.randrange(50) for _ in ends]), np.array(ends)


def same(x, y):
    return all(np.array_equal(p, q) for p, q in zip((x.pairs, x.times, *x.prefix, *x.suffix), (y.pairs, y.times, *y.prefix, *y.suffix), strict=True)) \
        and (x.ok, x.n_a, x.n_b, x.cut, x.n_groups, x.n_links, x.groups) == (y.ok, y.n_a, y.n_b, y.cut, y.n_groups, y.n_links, y.groups)


def test_fragments_compose_in_any_bracketing(tools):
    rng = random.Random(11)
    for _ in range(60):
        n = rng.randrange(4, 120)
        run = (*token_run(rng, n), *token_run(rng, n))
        cuts = sorted(rng.sample(range(n + 1), min(n, rng.randrange(1, 8))))
        parts = []
        for low, high in zip([0, *cuts], [*cuts, n]):
            a, b = [(x > low) & (x <= high) for x in (run[1], run[3])]
            parts.append(align.fragment((run[0][a], run[1][a], run[2][b], run[3][b]), tools))
        whole = align.fragment(run, tools)

        def tree(p):
            if len(p) < 2:
                return p[0]
            k = rng.randrange(1, len(p))
            return align.compose(tree(p[:k]), tree(p[k:]), tools)

        assert same(tree(parts), whole) and same(reduce(lambda x, y: align.compose(x, y, tools), parts, align.Fragment()), whole)
        done = align.finished(whole, tools)
        assert not len(done.suffix[0]) and done.n_links == len(set(run[1]) | set(run[3]))
        assert done.n_groups == len(set(run[1]) & set(run[3])) == done.groups.count(b";")


def test_ranges_cover_a_text_once():
    for text in filter(None, texts()):
        parts, data = align.ranges(text, 400), b" " + text.encode()
        assert [p[0] for p in parts] == [0, *[p[1] for p in parts[:-1]]] and parts[-1][1] == len(data)
        for low, high, start, context in parts:
            part = context.encode()
            assert data[start: start + len(part)] == part and start <= low and high <= start + len(part) and context[0] == " "
