"""Operators on conversations and embeddings, and the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from loomtext.llm import chat, embeddings, mixing, packing, quality, search, secrets, simhash

VECTORS = "vec_id long, embedding array<float>, label int, id string, v int, copy int, n string, part int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, None, None, None, None, 1)
                                  for i, v in rows], VECTORS)


def clustered(n=260, dims=16):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, dims))
    rows = [(i, centres[rng.integers(12)] + rng.normal(size=dims) * rng.choice([0.05, 0.3, 2])) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(5)] + [(2000, 3 * rows[3][1]), (2100, -rows[3][1])]
    return [(i, np.float32(v)) for i, v in rows]


ODD = [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [float("nan")] + [1.0] * 15), (5004, [None] + [1.0] * 15),
       (5005, [float("inf")] * 16), (None, [1.0] * 16), (None, None)]


def test_chat_round_trip(spark):
    rng = random.Random(7)
    nasty = ["<|turn|>", "<|more|>", "<|end|>\n", "<\\|x", "<\\\\|", "<", "|", "\\", "", None, "\n", "é🙂", "<|", "a$1b", "</s>[INST] ok [/INST]"]
    rows, want = [], {}
    for c in [*range(40), None, -1]:
        turns = []
        for n in range(rng.randrange(1, 7)):
            text = None if rng.random() < 0.1 else "".join(rng.choice([x or "" for x in nasty]) for _ in range(rng.randrange(4)))
            turns.append((n, rng.choice(["user", "assistant", "<|turn|>", "a\nb", ""]), text))
        rows += [(c, *t, "x", 1) for t in turns]
        want[c] = [(r, t or "") for _, r, t in turns]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string, turns int")
    formatted = chat.format_conversations(df)
    for r in chat.digest(formatted).join(formatted, "conv_id").collect():
        turns, loss = want[r.conv_id], "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(r.formatted) == sum(x.chars for x in r.loss_runs)
        at, masked = 0, []
        for x in r.loss_runs:
            if x.loss:
                masked.append(r.formatted[at: at + x.chars])
            at += x.chars
        assert sum(map(len, masked)) == r.masked_chars
        assert r.formatted.count("<|turn|>") == 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_ties_and_repeats(spark):
    df = spark.createDataFrame([(1, 0, "b", "y"), (1, 0, "a", "z"), (1, 0, "a", "z"), (1, None, None, None)],
                               "conv_id long, turn int, role string, text string")
    assert chat.format_conversations(df).first().formatted == \
        "<|turn|>\n<|end|>\n<|turn|>a\nz<|more|>z<|end|>\n<|turn|>b\ny<|end|>\n"


@pytest.mark.parametrize("block", [embeddings.LIST_BLOCK, 7])
def test_embedding_links_match_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(embeddings.link_lists, "__defaults__", (embeddings.COSINE, block, embeddings.LISTED, embeddings.SHARED))
    rows = clustered()
    got = {r.vec_id: r for r in embeddings.near_duplicates(vectors(spark, rows + ODD)).collect() if r.vec_id is not None}
    m = np.stack([v for _, v in rows]).astype(float)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    links = near.sum(axis=1) - 1
    found = np.array([got[i].n_links for i, _ in rows])
    assert (found <= links).all() and found.sum() >= 0.9 * links.sum()
    assert got[1000].n_links >= 6  # its copies, the first vector and its multiple
    for k, (i, _) in enumerate(rows):
        same = {got[rows[j][0]].component_id for j in np.flatnonzero(near[k])}
        assert found[k] < links[k] or same == {got[i].component_id}
        assert got[i].kept == (got[i].component_id == i)
    for i, _ in ODD[:6]:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_embedding_recall_on_given_vectors(spark):
    from loomtext.llm.queries import QUERIES
    folder = "/root/testdata/sf0.1"
    m = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    u = np.stack(m.embedding).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = dict(zip(m.vec_id, (u @ u.T >= 0.9).sum(axis=1) - 1))
    got = QUERIES["op6_embedding_near_dedup"](spark, folder).collect()
    assert all(r.n_links <= links[r.vec_id] for r in got)
    assert sum(r.n_links for r in got) >= 0.9 * sum(links.values())


@pytest.mark.parametrize(("n", "cosine"), [(1500, 0.92), (4000, 0.92), (4000, 0.98)])
def test_embedding_recall_in_a_hot_cluster(spark, n, cosine):
    """A third of the rows near one centre, each two of them at about ``cosine``."""
    rng = np.random.default_rng(n)
    u, centre = rng.normal(size=(n, 64)), rng.normal(size=64)
    spread = np.linalg.norm(centre) * np.sqrt((1 / cosine - 1) / 64)
    u[: n // 3] = centre + spread * u[: n // 3]
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(u)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    found = np.array([got[i].n_links for i in range(n)])
    assert (found <= links).all() and found.sum() >= 0.99 * links.sum() > n
    assert sum(r.kept for r in got.values()) == n - n // 3 + 1


def test_embedding_lists_hold_pairs_at_the_bound_in_any_width():
    """The share of pairs at cosine 0.9 that meet in a list, with the pivots of 60,000 and
    of at least 16,777,216 distinct vectors."""
    rng = np.random.default_rng(5)
    for n, width in [(60_000, 3), (60_000, 64), (1 << 24, 8)]:
        pivots = embeddings.directions(n, width)
        u, w = rng.normal(size=(2, 400, width))
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        w -= (w * u).sum(axis=1, keepdims=True) * u
        v = 0.9 * u + np.sqrt(1 - 0.81) * w / np.linalg.norm(w, axis=1, keepdims=True)
        a, b = [np.argsort(-x @ pivots.T, axis=1)[:, :embeddings.DEPTH] for x in (u, v)]
        met = (a[:, :embeddings.LISTED, None] == b[:, None, :embeddings.LISTED]).any(axis=(1, 2))
        assert (met & ((a[:, :, None] == b[:, None]).sum(axis=(1, 2)) >= embeddings.SHARED)).mean() >= 0.95


def test_embedding_vectors_meet_one_exchange_on_their_way_to_the_lists(spark):
    rows = spark.createDataFrame([(i, np.float32(v).tolist(), 1) for i, (_, v) in enumerate(clustered())], "id long, v array<float>, n long")
    described = embeddings.describe(rows, rows.count(), 16)
    assert described.schema["v"].dataType == rows.schema["v"].dataType
    plan = embeddings.link_lists(described, 16)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_embedding_links_do_not_depend_on_the_component_type(spark):
    rows, found = clustered(), []
    for kind in ("float", "double"):
        df = vectors(spark, rows + ODD)
        df = df.withColumn("embedding", df["embedding"].cast(f"array<{kind}>"))
        found.append(sorted(map(str, embeddings.near_duplicates(df).collect())))
    assert found[0] == found[1]


def test_embedding_tables_without_links(spark):
    assert embeddings.near_duplicates(vectors(spark, ODD)).count() == len(ODD)
    assert embeddings.near_duplicates(vectors(spark, ODD).limit(0)).count() == 0
    assert [r.n_links for r in embeddings.near_duplicates(vectors(spark, [(1, [1, 0]), (2, [1])])).collect()] == [1, 1]


@pytest.mark.parametrize("sizes", [(8192, 512), (30, 2)])
def test_search_matches_brute_force(spark, sizes):
    rows = [*clustered(), (300, clustered()[7][1]), (7, clustered()[7][1]), *ODD]
    got = search.top_k(vectors(spark, rows), block_rows=sizes[0], query_rows=sizes[1]).collect()
    ok = {i: [int(x) for x in np.floor(1024 * v.astype(float))] for i, v in rows[:-len(ODD)]}
    want = []
    for q in sorted(i for i in ok if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ok[q], ok[i])), i) for i in ok if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10])]
    assert sorted(map(tuple, got)) == want


def test_search_takes_equal_rows_as_candidates(spark):
    rows = [(100, [1.0, 0.0])] * 3 + [(7, [1.0, 0.0])] * 4 + [(8, [2.0, 0.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == sorted((100, k + 1, i) for _ in range(3) for k, i in enumerate([8, 7, 7, 7, 7, 100, 100]))


def test_loss_digest_follows_the_mask(spark):
    """A mask moved off the assistant's text shows in the digest."""
    rows = [(1, 0, "user", "one <|end|>"), (1, 1, "assistant", "two <|more|> é"), (1, 2, "assistant", "three")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    right = chat.digest(formatted).first()
    assert right.loss_sha256 == hashlib.sha256("two <|more|> éthree".encode()).hexdigest() and right.loss_chars == 19
    flipped = formatted.selectExpr("conv_id", "formatted", "transform(loss_runs, r -> struct(r.chars as chars, not r.loss as loss)) as loss_runs")
    wrong = chat.digest(flipped).first()
    assert wrong.turns_sha256 == right.turns_sha256 and wrong.loss_sha256 != right.loss_sha256


def test_search_few_rows_and_large_numbers(spark):
    big = [(100, [1e15, 1.0]), (1, [1e15, 2.0]), (2, [1e15, 3.0])]
    got = search.top_k(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (2, 2)]  # both stop at 64 bits
    assert search.top_k(vectors(spark, ODD)).count() == 0
    assert search.top_k(vectors(spark, [(100, [1.0])])).count() == 0


def test_search_scores_beyond_64_bits_tie_whatever_the_blocks(spark):
    rows = [(100, [1e10, 0.5])] + [(i, [1e10 + 2e3 * i, 0.5]) for i in range(1, 31)] + [(i, [-1e10 - i, 0.5]) for i in range(31, 36)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for size in (8192, 3):
        got = sorted((r["rank"], r.vec_id, r.score) for r in search.top_k(df, block_rows=size).collect())
        assert got == [(i, i, (1 << 63) - 1) for i in range(1, 11)]
    rows = [(100, [-1e10, 0.5])] + [(i, [1e10 - 2e3 * i, 0.5]) for i in range(1, 31)]
    got = sorted((r["rank"], r.vec_id, r.score) for r in search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(i, i, -(1 << 63)) for i in range(1, 11)]


def test_search_takes_rows_without_id_as_candidates(spark):
    rows = [(100, [1.0, 0.0]), (None, [3.0, 0.0]), (None, [2.0, 0.0]), (7, [2.0, 0.0]), (None, None), (8, [1.0, 0.0])]
    got = sorted(map(tuple, search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()))
    unit = 1 << 20
    assert got == [(100, 1, None, 3 * unit), (100, 2, 7, 2 * unit), (100, 3, None, 2 * unit), (100, 4, 8, unit)]


def test_pipeline_stages_follow_their_operators(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for (name, stage), k in zip(corpus_pipeline.STAGES, range(9)):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == columns
        if name == "quality classifier":
            want = {r.doc_id for r in quality.classify_quality(docs, labels).where("predicted = 1").collect()}
            assert {r.doc_id for r in out.collect()} == want and want
        elif name == "SimHash near-dedup":
            found = simhash.simhash_components(docs).collect()
            assert sorted(r.doc_id for r in out.collect()) == sorted({r.component_id for r in found})
        elif name == "secret scans":
            assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in docs.collect())
            judged = secrets.judged_spans(out).where("not copied and kind < 3").collect()
            assert not judged
        elif name == "mixing sources":
            taken = {r.doc_id: r for r in mixing.mix_sources(docs).collect()}
            got = [r.doc_id for r in out.collect()]
            of = {r.doc_id: r.source for r in docs.collect()}
            for source in set(of.values()):  # every source's words to a document
                own = [taken[i] for i in of if of[i] == source and taken[i].size]
                emitted = sum(got.count(r.doc_id) * r.size for r in own)
                assert abs(emitted - sum(r.taken for r in own)) <= max((r.size for r in own), default=0)
            assert all(got.count(i) == 1 if not r.size else got.count(i) <= 3 for i, r in taken.items())
        else:
            assert sorted(map(str, out.collect())) == sorted(map(str, packing.pack(docs).collect()))
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert sorted(map(str, corpus_pipeline.run(spark, sf).collect())) == sorted(map(str, docs.collect()))


def test_pipeline_near_dedup_keeps_other_texts_of_an_id(spark):
    a, b, c, d = [" ".join(f"{x}{k * k % 97}" for k in range(40)) for x in "abcd"]
    rows = [(3, a), (5, a), (5, b), (5, b), (None, a), (None, c), (6, d), (None, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(3, a), (5, b), (None, c), (6, d)], key=str)


def test_pipeline_mix_meets_the_words_of_each_source(spark):
    rng = random.Random(3)
    sizes = lambda n: [rng.choice([30, 200, 500, 2000]) for _ in range(n)]
    rows = [(f"s{k:02}", x) for k in range(20) for x in sizes(300 if k == 0 else 30)]
    docs = spark.createDataFrame([(i, "w " * x, s, x) for i, (s, x) in enumerate(rows)], "doc_id long, text string, source string, x int")
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(docs).collect()}
    out = [r.doc_id for r in corpus_pipeline.mix(spark, docs, "").collect()]
    assert max(out.count(i) for i in taken) <= 3
    for k in range(20):
        own = [i for i, (s, _) in enumerate(rows) if s == f"s{k:02}"]
        emitted = sum(out.count(i) * rows[i][1] for i in own)
        assert abs(emitted - sum(taken[i] for i in own)) <= 2000
    for x in (30, 200, 500, 2000):  # no length of the hot source is lost
        own = [i for i, (s, y) in enumerate(rows) if s == "s00" and y == x]
        assert abs(sum(out.count(i) for i in own) - sum(taken[i] / x for i in own)) <= 1.01


def test_pipeline_stages_on_odd_rows(spark):
    rows = [(1, "a b c", "en", "s", 5, 1), (1, "a b c", "en", "s", 5, 1), (2, None, None, None, None, 2), (3, "", "en", None, 0, 3),
            (None, "a b c", "en", "s", 5, 4), (None, "other words here", "en", "s", 5, 4), (4, "x " * 20_000, "en", "t", 1, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp int")
    sf = "/root/testdata/sf0.001"
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, df, sf).count() <= 3 * df.count()
    once = corpus_pipeline.near_dedup(spark, docs, sf).collect()
    assert sorted(r.doc_id for r in once if r.doc_id is not None) == [1, 2, 4]


def row_moves(df):
    """Shuffles of the column ``row`` on each path of the plan that begins with it."""
    def walk(plan, moves):
        names = [plan.output().apply(i).name() for i in range(plan.output().size())]
        moves += plan.nodeName() == "Exchange" and "row" in names
        below = [plan.children().apply(i) for i in range(plan.children().size())]
        if not any("row" in [c.output().apply(i).name() for i in range(c.output().size())] for c in below) and "row" in names:
            return [moves]
        return [m for c in below for m in walk(c, moves)]
    return sorted(walk(df._jdf.queryExecution().executedPlan().executedPlan(), 0))


@pytest.fixture
def no_broadcasts(spark):
    """Small tables join as large ones do."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pipeline_near_dedup_moves_a_row_once(no_broadcasts):
    docs = no_broadcasts.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "other words")], "doc_id long, text string")
    out = corpus_pipeline.near_dedup(no_broadcasts, docs, "")
    assert row_moves(out) == [1]
    assert sorted(r.doc_id for r in out.collect()) == [1, 2]


def test_texts_without_secrets_stay_where_they_are(no_broadcasts):
    rows = [(i, f"k {i} password=Private{i}Value99" if i % 10 == 0 else f"nothing here {i}", f"s{i}", "en") for i in range(200)]
    rows += [(None, None, None, None), (None, "token=NobodysValue123", None, None), (None, "token=NobodysValue123", None, None)]
    docs = no_broadcasts.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = secrets.redact(docs)
    assert row_moves(out) == [0, 1]
    masked = [re.sub("=.*", "=[SECRET]", t) if t else t for _, t, _, _ in rows]
    want = sorted(str((i, t, s)) for (i, _, s, _), t in zip(rows, masked))
    for bits in (secrets.FILTER_BITS, 64, 128):  # with few marks most rows move, to the same end
        assert sorted(str((r.doc_id, r.text, r.source)) for r in secrets.redact(docs, bits=bits).collect()) == want
    named = secrets.named_rows(docs)
    found = named.where("text like '%=%'").select(named["copy"].alias("of_copy"))
    may = {bits: {r.id for r in secrets._marked(named, found, bits).where("may").collect()} for bits in (secrets.FILTER_BITS, 64)}
    holding = {i for i, t, _, _ in rows if t and "=" in t}
    assert holding <= may[64] and holding <= may[secrets.FILTER_BITS] and len(may[secrets.FILTER_BITS]) < 30
