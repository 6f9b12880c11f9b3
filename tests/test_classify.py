import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, rows
from loomtext.operators.classify import classify, index_rules, ranked_rules, rules_frame, url_grams
from loomtext.plans import corpus
from loomtext.sources.tables import table

RULES = [(1, ".example.com", "0001"), (2, "blog.", "0002"), (3, ".shop.example.com", "0003"),
         (4, ".tie.com", "0002"), (5, ".tie.com", "0015"), (6, ".pad.com", "0001"), (7, ".pad.com", "0019 "),
         (8, "tie.com", "0009")]
URLS = [(1, "http://x.shop.example.com/a", "0003"), (2, "http://a.example.com/blog.html", "0001"),
        (3, "http://z.org/blog.html", "0002"), (4, "http://a.tie.com/", "0002"), (5, "http://tie.com/", "0009"),
        (6, "http://a.pad.com/", "0019"), (7, "http://A.EXAMPLE.COM/", None),
        (8, "http://none.org/?r=.example.com", "0001"), (9, None, None)]


def naive(records, rules):
    """Every record against every rule: the definition J1 must equal."""
    rk = ranked_rules(rules)
    hay = F.concat(F.lit("url="), F.col("url"))
    hits = records.crossJoin(rk.select("pattern", "tag", "category", "rank_key")).where(
        F.instr(hay, F.col("pattern")) > 0)
    best = hits.groupBy("rec_id").agg(F.min("rank_key").alias("rank_key"))
    return best.join(rk.select("rank_key", "category"), "rank_key").select("rec_id", "category")


def test_golden_rules(spark):
    recs = spark.createDataFrame([(i, u) for i, u, _ in URLS], "rec_id long, url string")
    out = classify(recs, rules_frame(spark, RULES))
    got = {r["rec_id"]: (r["category"], r["tag"]) for r in out.collect()}
    want = {i: c for i, _, c in URLS if c}
    assert {k: v[0] for k, v in got.items()} == want
    assert got[6][1] == "0019 "  # the spaced tag won and is kept raw


def test_kgram_join_equals_naive_on_pages(spark):
    pages = table(spark, SF_ORACLE, "pages")
    rules = corpus.page_rules(spark, pages)
    recs = pages.select(F.col("page_id").alias("rec_id"), "url")
    fast = {tuple(r) for r in classify(recs, rules).select("rec_id", "category").collect()}
    slow = {tuple(r) for r in naive(recs, rules).collect()}
    assert fast == slow and len(fast) > 0


def test_plan_has_no_nested_loop_or_python(spark):
    pages = table(spark, SF_ORACLE, "pages")
    recs = pages.select(F.col("page_id").alias("rec_id"), "url")
    out = classify(recs, corpus.page_rules(spark, pages))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BroadcastHashJoin" in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_layout_invariance(spark):
    pages = table(spark, SF_ORACLE, "pages")
    rules = corpus.page_rules(spark, pages)
    recs = pages.select(F.col("page_id").alias("rec_id"), "url")
    a = {tuple(r) for r in classify(recs.repartition(1), rules).collect()}
    b = {tuple(r) for r in classify(recs.repartition(17), rules).collect()}
    assert a == b


def test_shuffled_rule_join_equals_naive(spark):
    # broadcast_bytes=0 forces the shuffle join on k-grams used for very large rule tables
    pages = table(spark, SF_ORACLE, "pages")
    rules = corpus.page_rules(spark, pages)
    recs = pages.select(F.col("page_id").alias("rec_id"), "url")
    out = classify(recs, rules, broadcast_bytes=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan
    fast = {tuple(r) for r in out.select("rec_id", "category").collect()}
    assert fast == {tuple(r) for r in naive(recs, rules).collect()}


def test_repeated_urls(spark):
    recs = spark.createDataFrame([(i, u) for i, u, _ in URLS] + [(100 + i, u) for i, u, _ in URLS],
                                 "rec_id long, url string")
    rules = rules_frame(spark, RULES)
    got = classify(recs, rules).select("rec_id", "category").collect()
    a = {tuple(r) for r in got}
    b = {tuple(r) for r in naive(recs, rules).collect()}
    assert a == b and len(a) == len(got) == 14


def test_shuffled_rule_join_prefilters_grams(spark):
    # rules too many to broadcast, distinct first grams few enough: URL grams are
    # semi-joined against the broadcast gram set before the shuffled join
    pages = table(spark, SF_ORACLE, "pages")
    rules = corpus.page_rules(spark, pages)
    n = rules.select(F.sum(F.octet_length("pattern") + F.octet_length("tag"))).first()[0] + 40 * rules.count()
    recs = pages.select(F.col("page_id").alias("rec_id"), "url")
    out = classify(recs, rules, broadcast_bytes=n)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    fast = {tuple(r) for r in out.select("rec_id", "category").collect()}
    assert fast == {tuple(r) for r in naive(recs, rules).collect()}


def test_large_ord_and_tied_rules(spark):
    rules = rules_frame(spark, [(1 << 40, "a.com", "0002"), (1 << 40, "a.com", "0001"), (1 << 40, "a.com", "0001")])
    recs = spark.createDataFrame([(1, "http://a.com/")], "rec_id long, url string")
    assert [r["tag"] for r in classify(recs, rules).collect()] == ["0001"]


def test_no_html_in_the_gram_plan(spark):
    from loomtext.plans.catalog import QUERIES
    plan = QUERIES["category_counts"](spark, SF_ORACLE)._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan


def test_shared_starts_and_one_short_pattern(spark):
    # 5,000 rules that start alike: candidates stay near the hits, whether or not the
    # table also holds a pattern of one character
    many = [(i, f"www.site{i:04d}.example.com", f"{i % 32:04d}") for i in range(5000)]
    recs = spark.createDataFrame([(i, f"http://www.site{i * 7 % 6000:04d}.example.com/p{i}") for i in range(600)],
                                 "rec_id long, url string")
    rules = rules_frame(spark, many)
    index = index_rules(rules)
    hits = url_grams(recs, [8]).join(index, "_gram")
    real = hits.where(F.instr("_hay", F.col("_pat")) > 0).count()
    assert 0 < real <= hits.count() <= 3 * real
    short = index_rules(rules.unionByName(rules_frame(spark, [(9000, "~", "0099")])))
    assert rows_of(short.where("k = 8")) == rows_of(index)
    fast = {tuple(r) for r in classify(recs, None, index=index).select("rec_id", "category").collect()}
    assert fast == {tuple(r) for r in naive(recs, rules).collect()}


def rows_of(index):
    return {(r["_gram"], r["_pat"]) for r in index.collect()}


def test_every_length_class_equals_naive(spark):
    rules = rules_frame(spark, [(1, "~", "0001"), (2, "/a", "0002"), (3, ".com", "0003"), (4, "example.", "0004"),
                                (5, "aaaaaaaaaa", "0005"), (6, "aaa", "0006"), (7, "\u00e9\U0001F600", "0007"), (8, "url=h", "0008")])
    recs = spark.createDataFrame(list(enumerate(["http://example.com/~x", "f/a", "", "~", "x.example.", "aaaaaaaaaaaa", "baaab",
                                                 "z\u00e9\U0001F600", "http", None])), "rec_id long, url string")
    for limit in (1 << 20, 0):
        got = {tuple(r) for r in classify(recs, rules, broadcast_bytes=limit).select("rec_id", "category").collect()}
        assert got == {tuple(r) for r in naive(recs, rules).collect()}


def test_no_rules_and_empty_pattern(spark):
    recs = spark.createDataFrame([(1, "http://a.com/")], "rec_id long, url string")
    assert classify(recs, rules_frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        classify(recs, rules_frame(spark, [(1, "", "0001")]))


def test_grams_that_most_urls_share_index_no_rule(spark):
    """Every gram of a pattern is held by few patterns; its middle is in every URL."""
    rules = rules_frame(spark, [(i, f"/archive/pages/q{i:03}", f"{i:04}") for i in range(40)])
    urls = [f"http://h.org/archive/pages/q{i % 2000:04}/x" for i in range(4000)] + ["http://h.org/archive/pages/q0390"]
    recs = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "id long, url string")
    met = {}
    for name, index in (("rules", index_rules(rules)), ("both", index_rules(rules, recs))):
        met[name] = url_grams(recs, [8]).join(index, "_gram").count()
    hits = sum(any(f"/archive/pages/q{i:03}" in u for i in range(40)) for u in set(urls))
    assert met["both"] <= 2 * hits and hits <= met["rules"]
    one = rules_frame(spark, [(1, "archive/pages/q0390", "0001")])  # one rule: all its grams are equally rare among rules
    joined = lambda index: url_grams(recs, [8]).join(index, "_gram").count()
    assert joined(index_rules(one)) == 2001 and joined(index_rules(one, recs)) <= 20
    a, b = [rows(classify(recs, rules, index=x).select("id", "tag")) for x in (index_rules(rules), index_rules(rules, recs))]
    assert a == b == rows(classify(recs, rules).select("id", "tag")) and a
