"""Registered queries over the driver tables and their DuckDB oracle SQL.

Each query reads whole tables (or tables Spark derives from them) and returns a lazy
DataFrame. Column names and types match the oracle SQL of the same name. Floating
results are rounded to a fixed number of decimals in both, so engines that differ in
the last bit of a logarithm or a summation order still agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions.bits import day_boundary_ms
from loomtext.functions.records import field_value, last_field, record_identity, record_pairs
from loomtext.functions.text import suffixed_tokens
from loomtext.functions.urls import PREFIX_REGEX, canonical_url, domain_parts, domain_path, site_dirs
from loomtext.operators import daily
from loomtext.operators.activity import active_days
from loomtext.operators.bayes import Bayes, load_bayes, predict_bayes
from loomtext.operators.classify import classify
from loomtext.operators.evaluate import holdout_metrics
from loomtext.operators.forest import POISSON, VOTE, grow_forest, load_forest, predict_forest
from loomtext.operators.joins import key_join
from loomtext.operators.models import fit_naive_bayes, fit_random_forest, nb_tables, predict, to_vectors
from loomtext.operators.sampling import hash_sample, one_per_key, split_column, two_stage_sample
from loomtext.operators.select import chi_square, reindex, top_features
from loomtext.operators.sites import site_rollup
from loomtext.operators.vectors import binary_vectors, count_vectors, counted_instances, distinct_tokens, \
    tfidf_vectors
from loomtext.operators.vocab import class_count, vocabulary
from loomtext.operators.weights import doc_frequency, idf
from loomtext.operators.wordcount import blob_lines, word_count
from loomtext.plans import corpus
from loomtext.session import reliable_checkpoint, scratch_path
from loomtext.sinks.text import libsvm_lines
from loomtext.sources.tables import spread, table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries (reference defaults where it has them).
PATH_RULES = [o for o, p, _ in corpus.SEED_RULES if not p.startswith(".example.")]
SAMPLE_FRACTION = 0.1
TEST_FRACTION = 0.3
TOP_K = 100
SMOOTHING = 0.1
RF_TREES, RF_DEPTH, RF_BINS, RF_SEED = 100, 4, 32, 7
WEEK_DAYS = 7
DIGITS = 10  # decimals kept for floating results
CHI_DIGITS = 6

# ---------------------------------------------------------------------------------------
# Shared Spark building blocks


def _pages(spark, sf):
    return corpus.page_records(table(spark, sf, "pages"))


def _classified(spark, sf):
    pages = table(spark, sf, "pages")
    recs = corpus.page_records(pages).select("page_id", "url", "title", "kw")
    return classify(recs, corpus.page_rules(spark, pages))


def _docs(spark, sf):
    docs, _ = corpus.labelled_docs(spark, sf)
    return docs


def _corpus(spark, sf):
    """Token documents, their counted instances (lazy) and the vocabulary.

    The vocabulary counts one row per (document, feature), so it is built from the
    distinct tokens of each document (no term counting needed); only count vectors
    need the counted instances. Tokenising in the row is narrow and cheaper to redo
    than a table about as large as the text is to write and read back."""
    docs = _docs(spark, sf)
    inst = counted_instances(docs)
    features = distinct_tokens(docs).withColumnRenamed("token", "feature")
    return docs, inst, vocabulary(features)


def _count_entries(spark, sf, store=False):
    """Count vectors. ``store=True`` (for the training chain, which reads them several
    times) stores the counted instances once and builds both the vocabulary and the
    vectors from them, so the text is tokenised in one pass; a single use keeps them
    lazy."""
    if not store:
        docs, inst, voc = _corpus(spark, sf)
        return docs, count_vectors(inst, voc, one_row_per_feature=True)
    docs, inst, voc = _stored_corpus(spark, sf)
    return docs, count_vectors(inst, voc, one_row_per_feature=True)


def _stored_corpus(spark, sf):
    docs = _docs(spark, sf)
    inst = reliable_checkpoint(counted_instances(docs), "instances")
    return docs, inst, vocabulary(inst)


def _entries(inst, voc):
    cv = count_vectors(inst, voc, one_row_per_feature=True)
    return cv.select("doc_id", "label", (F.col("fid") - 1).alias("fidx"), "value")


def _selected(spark, sf):
    """The top-k features by chi-square over the count vectors of the stored instances, and
    the count vectors of these features: a feature that is not selected meets none of the
    few rows of the vocabulary that are left, so the rest of it never travels."""
    docs, inst, voc = _stored_corpus(spark, sf)
    alld = reliable_checkpoint(docs.select("doc_id", "label"), "labels")  # N, label counts and both splits
    top = reliable_checkpoint(top_features(chi_square(_entries(inst, voc), alld), TOP_K))
    picked = voc.join(F.broadcast(top.select((F.col("fidx") + 1).alias("fid"))), "fid", "left_semi")  # TOP_K rows at most
    return alld, _entries(inst, reliable_checkpoint(picked, "selected-vocabulary")), top


def _split_sets(spark, sf):
    """Both splits of the documents and their reindexed vectors, which are stored: the
    learner and the holdout read them, several times."""
    alld, entries, top = _selected(spark, sf)
    rv = reliable_checkpoint(reindex(entries, top), "selected-entries")
    n_feat = top.count()
    # the split depends on the document id alone: a filter on either side, no join
    part = split_column("doc_id", TEST_FRACTION)
    train_docs, test_docs = [alld.where(part == p).select("doc_id", "label") for p in ("train", "test")]
    train_e, test_e = [rv.where(part == p) for p in ("train", "test")]
    return train_docs, train_e, test_docs, test_e, n_feat


def _nb_scored(spark, sf):
    train_docs, train_e, test_docs, test_e, n_feat = _split_sets(spark, sf)
    model = fit_naive_bayes(to_vectors(train_e, train_docs, n_feat), SMOOTHING)
    tv = to_vectors(test_e, test_docs, n_feat)
    return model.transform(tv).select("doc_id", "label", "n_entries", "prediction")


def _r(c, digits=DIGITS):
    return F.round(F.col(c), digits).alias(c)


# ---------------------------------------------------------------------------------------
# Queries


def q_word_count(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return word_count(blob_lines(docs, "text"))


def q_record_fields(spark, sf):
    line = F.col("line")
    return _pages(spark, sf).select(
        "page_id", last_field(line, "url").alias("url"), last_field(line, "tit").alias("tit"),
        last_field(line, "kw").alias("kw"), field_value(line, "url").alias("url_first"))


def q_record_pairs(spark, sf):
    return record_pairs(_pages(spark, sf).select("page_id", "line"), "line", "page_id")


def q_sample_tokens(spark, sf):
    """P2-P5 + F2 on labelled pages: ``category tok_1 ... tok_2 ...`` documents."""
    c = _classified(spark, sf)
    toks = F.concat(suffixed_tokens(F.col("title"), "_1"), suffixed_tokens(F.col("kw"), "_2"))
    cate = F.substring(F.col("tag"), 1, 4)
    d = c.select("page_id", cate.alias("category"), toks.alias("_t")).where(F.size("_t") > 0)
    return d.select("page_id", "category",
                    F.concat_ws(" ", F.col("category"), F.array_join("_t", " ")).alias("doc"),
                    F.size("_t").alias("n_tokens"))


def q_url_canonical(spark, sf):
    return table(spark, sf, "pages").select("page_id", canonical_url(F.col("url")).alias("canonical"))


def q_url_site_dirs(spark, sf):
    return table(spark, sf, "pages").select("page_id", site_dirs(F.col("url")).alias("site_dirs"))


def q_url_domain_parts(spark, sf):
    return table(spark, sf, "pages").select("page_id", domain_parts(F.col("url")).alias("d")).select(
        "page_id", "d.domain", "d.p1", "d.p2")


def q_url_domain_path(spark, sf):
    return table(spark, sf, "pages").select("page_id", domain_path(F.col("url")).alias("d")).select(
        "page_id", "d.domain", "d.path")


def q_site_rollup(spark, sf):
    return site_rollup(table(spark, sf, "pages"))


def q_classify_url(spark, sf):
    return _classified(spark, sf).select("page_id", "url", "pattern", "tag", "category")


def q_path_rules(spark, sf):
    """J1 and F1 under the seed rules that name no whole domain: many pages hit none."""
    pages = table(spark, sf, "pages")
    rules = corpus.page_rules(spark, pages).where(F.col("ord").isin(PATH_RULES))
    return classify(pages.select("page_id", "url"), rules).select("page_id", "pattern", "tag", "category")


def q_repeated_fields(spark, sf):
    """S3 and P1 on lines that name two fields twice: the last wins, field values take the first."""
    pages = _pages(spark, sf)
    line = F.concat("line", F.lit("`url="), "title", F.lit("`kw=again"))
    return pages.select("page_id", line.alias("line")).select(
        "page_id", last_field(F.col("line"), "url").alias("url"), last_field(F.col("line"), "kw").alias("kw"),
        field_value(F.col("line"), "url").alias("url_first"))


def q_category_counts(spark, sf):
    return _classified(spark, sf).groupBy("category").agg(F.count(F.lit(1)).alias("pages"))


def q_dedupe_title(spark, sf):
    c = _classified(spark, sf).select("page_id", "title", "url", "category")
    return one_per_key(c, key="title", order="page_id")


def q_hash_sample(spark, sf):
    return hash_sample(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", SAMPLE_FRACTION)


def q_two_stage_sample(spark, sf):
    return two_stage_sample(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id",
                            SAMPLE_FRACTION, SAMPLE_FRACTION)


def q_train_test_split(spark, sf):
    return table(spark, sf, "documents").select("doc_id", split_column("doc_id", TEST_FRACTION).alias("part"))


def q_label_dictionary(spark, sf):
    _, dictionary = corpus.labelled_docs(spark, sf)
    return dictionary


def q_class_count(spark, sf):
    _, dictionary = corpus.labelled_docs(spark, sf)
    return class_count(dictionary)


def q_whitelist_filter(spark, sf):
    return _docs(spark, sf).select("doc_id", "label")


def q_vocabulary(spark, sf):
    return _corpus(spark, sf)[2]


def q_binary_vectors(spark, sf):
    docs, _, voc = _corpus(spark, sf)
    return binary_vectors(docs, voc)


def q_count_vectors(spark, sf):
    return _count_entries(spark, sf)[1]


def _binary_idf(spark, sf):
    """Binary vectors stored once: document frequencies and the document total both
    read the stored table (the reference wrote this libsvm file and read it back)."""
    docs, _, voc = _corpus(spark, sf)
    bv = reliable_checkpoint(binary_vectors(docs, voc), "binary-entries")
    return docs, voc, idf(bv, bv.select("doc_id").distinct())


def q_doc_frequency(spark, sf):
    docs, _, voc = _corpus(spark, sf)
    return doc_frequency(binary_vectors(docs, voc))


def q_idf(spark, sf):
    return _binary_idf(spark, sf)[2].select("fidx", "df", _r("idf"))


def q_tfidf_vectors(spark, sf):
    docs, voc, w = _binary_idf(spark, sf)
    return tfidf_vectors(docs, voc, w).select("doc_id", "label", "fid", _r("value"))


def q_chi_square(spark, sf):
    docs, cv = _count_entries(spark, sf, store=True)
    entries = cv.select("doc_id", "label", (F.col("fid") - 1).alias("fidx"), "value")
    return chi_square(entries, docs.select("doc_id", "label")).select("fidx", _r("chi2", CHI_DIGITS))


def q_top_features(spark, sf):
    return _selected(spark, sf)[2].select("fidx", "new_fidx", _r("chi2", CHI_DIGITS))


def q_reindexed_vectors(spark, sf):
    _, entries, top = _selected(spark, sf)
    return reindex(entries, top)


def _days(spark, sf):
    """Each third of the documents as a day of its own: statistics stored, loaded, added up."""
    docs, paths = _docs(spark, sf), []
    for day in range(3):
        own = docs.where(F.col("doc_id") % 3 == day)
        paths.append(scratch_path(spark, f"statistics-{day}"))
        daily.statistics(counted_instances(own), own).save(paths[-1])
    return paths


def q_merged_statistics(spark, sf):
    """A2, A3, A4, A7 from three stored days."""
    stats = daily.load_statistics(spark, _days(spark, sf))
    voc = reliable_checkpoint(daily.vocabulary_of(stats), "vocabulary")
    out = voc.select("feature", "cnt", (F.col("fid") - 1).alias("fidx"))
    out = out.join(daily.idf_of(stats, voc), "fidx").join(daily.chi_square_of(stats, voc), "fidx")
    return out.select("feature", "fidx", "cnt", "df", _r("idf"), _r("chi2", CHI_DIGITS))


def q_merged_theta(spark, sf):
    """A9 from three stored days, over the whole vocabulary."""
    stats = daily.load_statistics(spark, _days(spark, sf))
    voc = reliable_checkpoint(daily.vocabulary_of(stats), "vocabulary")
    return daily.bayes_of(stats, voc, voc.count(), SMOOTHING)[1].select("label", "fidx", _r("theta"))


def q_grown_dictionary(spark, sf):
    """The first day's dictionary, grown by the counts of all three."""
    paths = _days(spark, sf)
    first = reliable_checkpoint(daily.vocabulary_of(daily.load_statistics(spark, paths[:1])), "dictionary")
    counts = daily.load_statistics(spark, paths).cells.groupBy("feature").agg(F.sum("n").alias("cnt"))
    return daily.grown_dictionary(first.select("feature", "fid"), counts)


def q_nb_priors(spark, sf):
    train_docs, train_e, _, _, n_feat = _split_sets(spark, sf)
    priors, _ = nb_tables(train_e, train_docs, n_feat, SMOOTHING)
    return priors.select("label", "n_docs", _r("pi"), _r("theta_unseen"))


def q_nb_theta(spark, sf):
    train_docs, train_e, _, _, n_feat = _split_sets(spark, sf)
    _, theta = nb_tables(train_e, train_docs, n_feat, SMOOTHING)
    return theta.select("label", "fidx", _r("theta"))


def q_nb_predict(spark, sf):
    s = _nb_scored(spark, sf)
    return s.where(F.col("n_entries") > 0).select("doc_id", "label", "prediction")


def _nb_tables(spark, sf):
    """The naive Bayes tables saved and loaded, and the test documents that they label."""
    train_docs, train_e, test_docs, test_e, n_feat = _split_sets(spark, sf)
    path = scratch_path(spark, "bayes")
    Bayes(*nb_tables(train_e, train_docs, n_feat, SMOOTHING)).save(path)
    return predict_bayes(load_bayes(spark, path), test_e, test_docs)


def q_nb_table_predict(spark, sf):
    """M6, M7, K5: naive Bayes on tables, no vectors."""
    s = _nb_tables(spark, sf).where(F.col("n_entries") > 0)
    return s.select("doc_id", *[F.col(c).cast("double").alias(c) for c in ("label", "prediction")])


def q_table_metrics(spark, sf):
    """The holdout metrics of the table form."""
    m = holdout_metrics(_nb_tables(spark, sf))
    return m.select("total", "classified", "errors", _r("test_err"), _r("test_acc"), _r("test_rec"), _r("f1"))


def q_holdout_metrics(spark, sf):
    m = holdout_metrics(_nb_scored(spark, sf))
    return m.select("total", "classified", "errors", _r("test_err"), _r("test_acc"), _r("test_rec"), _r("f1"))


def q_rf_predict(spark, sf):
    """M5, K5, M7: the forest saved, loaded and asked."""
    train_docs, train_e, test_docs, test_e, n_feat = _split_sets(spark, sf)
    path = scratch_path(spark, "forest")
    grow_forest(train_e, train_docs, n_feat, RF_TREES, RF_DEPTH, RF_BINS, RF_SEED).save(path)
    asked = test_docs.join(test_e.select("doc_id"), "doc_id", "left_semi")
    found = predict_forest(load_forest(spark, path), test_e, asked, RF_TREES, RF_DEPTH)
    return found.select("doc_id", *[F.col(c).cast("double").alias(c) for c in ("label", "prediction")])


def q_rf_stump(spark, sf):
    """M5 where SQL can follow it: one tree of one split on binary vectors, no sampling."""
    train_docs, train_e, test_docs, test_e, n_feat = _split_sets(spark, sf)
    train_e, test_e = [e.withColumn("value", F.lit(1)) for e in (train_e, test_e)]
    model = fit_random_forest(to_vectors(train_e, train_docs, n_feat), 1, 1, RF_BINS, RF_SEED, bootstrap=False, subsets="all")
    return predict(model, to_vectors(test_e, test_docs, n_feat))


def q_token_dedupe(spark, sf):
    return distinct_tokens(_docs(spark, sf), keep=("doc_id",))


def q_key_join(spark, sf):
    orders = table(spark, sf, "orders")
    cust = table(spark, sf, "customer")
    kv = orders.select(F.col("o_custkey").cast("string").alias("key"), F.col("o_orderkey").cast("string").alias("value"))
    keys = cust.select(F.col("c_custkey").cast("string").alias("key")).unionAll(
        cust.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").cast("string").alias("key")))
    return key_join(kv, keys)


def q_identity(spark, sf):
    recs = corpus.event_records(table(spark, sf, "events"))
    return recs.select("event_id", record_identity(F.col("line")).alias("identity"))


def q_active_days(spark, sf):
    ev = table(spark, sf, "events").select("user_id", F.dayofmonth("ts").alias("day"))
    return active_days(ev, "user_id", "day")


def q_day_boundary(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
                     day_boundary_ms("ts", 0).alias("day_start_ms"),
                     day_boundary_ms("ts", WEEK_DAYS).alias("week_before_ms"))


def q_libsvm_text(spark, sf):
    docs, cv = _count_entries(spark, sf)
    return libsvm_lines(cv, docs.select("doc_id", "label"), value_format="%d")


QUERIES: dict[str, Query] = {
    "word_count": q_word_count,
    "record_fields": q_record_fields,
    "record_pairs": q_record_pairs,
    "sample_tokens": q_sample_tokens,
    "url_canonical": q_url_canonical,
    "url_site_dirs": q_url_site_dirs,
    "url_domain_parts": q_url_domain_parts,
    "url_domain_path": q_url_domain_path,
    "site_rollup": q_site_rollup,
    "classify_url": q_classify_url,
    "path_rules": q_path_rules,
    "repeated_fields": q_repeated_fields,
    "category_counts": q_category_counts,
    "dedupe_title": q_dedupe_title,
    "hash_sample": q_hash_sample,
    "two_stage_sample": q_two_stage_sample,
    "train_test_split": q_train_test_split,
    "label_dictionary": q_label_dictionary,
    "class_count": q_class_count,
    "whitelist_filter": q_whitelist_filter,
    "vocabulary": q_vocabulary,
    "binary_vectors": q_binary_vectors,
    "count_vectors": q_count_vectors,
    "doc_frequency": q_doc_frequency,
    "idf": q_idf,
    "tfidf_vectors": q_tfidf_vectors,
    "chi_square": q_chi_square,
    "top_features": q_top_features,
    "reindexed_vectors": q_reindexed_vectors,
    "merged_statistics": q_merged_statistics,
    "merged_theta": q_merged_theta,
    "grown_dictionary": q_grown_dictionary,
    "nb_priors": q_nb_priors,
    "nb_theta": q_nb_theta,
    "nb_predict": q_nb_predict,
    "nb_table_predict": q_nb_table_predict,
    "holdout_metrics": q_holdout_metrics,
    "table_metrics": q_table_metrics,
    "rf_predict": q_rf_predict,
    "rf_stump": q_rf_stump,
    "token_dedupe": q_token_dedupe,
    "key_join": q_key_join,
    "identity": q_identity,
    "active_days": q_active_days,
    "day_boundary": q_day_boundary,
    "libsvm_text": q_libsvm_text,
}

# ---------------------------------------------------------------------------------------
# Oracle SQL (DuckDB). Shared pieces are CTE texts composed below.

_JTRIM = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def _jtrim(x: str) -> str:
    return _JTRIM.format(x=x)


def _hash(expr: str, salt: str) -> str:
    return f"('0x' || substr(md5('{salt}' || CAST({expr} AS VARCHAR)), 1, 8))::BIGINT"


def _canon(x: str) -> str:
    return f"regexp_replace(lower({x}), '{PREFIX_REGEX}', '')"


_SEED_VALUES = ",\n    ".join(f"({o}, '{p}', '{t}')" for o, p, t in corpus.SEED_RULES)

SQL_LINES = r"""
lines AS (
  SELECT doc_id, unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                             WHEN parts[-1] = '' THEN parts[1:len(parts) - 1]
                             ELSE parts END) AS line
  FROM (SELECT doc_id, text, string_split_regex(text, '\r\n|\r|\n') AS parts FROM documents))"""

SQL_RECS = r"""
recs AS (
  SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
         array_to_string(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1), ' ') AS kw
  FROM pages),
precs AS (SELECT *, 'url=' || url || '`tit=' || title || '`kw=' || kw AS line FROM recs)"""

SQL_RULES = f"""
seed(ord, pattern, tag) AS (VALUES
    {_SEED_VALUES}),
hosts AS (
  SELECT pattern, min(page_id) + {corpus.HOST_RULE_ORD_BASE} AS ord
  FROM (SELECT regexp_extract(url, '{corpus.HOST_RE}', 1) AS pattern, page_id FROM pages)
  WHERE pattern <> '' GROUP BY pattern),
rules AS (
  SELECT ord, pattern, tag FROM seed
  UNION ALL
  SELECT ord, pattern, lpad(CAST(b % 32 + 1 AS VARCHAR), 4, '0') AS tag
  FROM (SELECT ord, pattern, {_hash('pattern', corpus.HOST_SALT)} AS b FROM hosts)),
ranked AS (
  SELECT ord, pattern, tag, {_jtrim('tag')} AS category, length(lit) AS lit_len,
         CASE WHEN st = '' THEN 0 ELSE length(st) - length(replace(st, '.', '')) + 1 END AS pieces
  FROM (SELECT *, regexp_replace(lit, '\\.+$', '') AS st
        FROM (SELECT *, pattern || '``' || tag AS lit FROM rules))),
hits AS (
  SELECT r.page_id, r.url, r.title, r.kw, u.ord, u.pattern, u.tag, u.category, u.pieces, u.lit_len
  FROM recs r JOIN ranked u ON contains('url=' || r.url, u.pattern)),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pieces DESC, lit_len DESC, ord, pattern, tag) AS rn
                 FROM hits) WHERE rn = 1)"""

SQL_DOCS = r"""
dict AS (
  SELECT name, CAST(row_number() OVER (ORDER BY name) - 1 AS INTEGER) AS category_id
  FROM (SELECT DISTINCT lang AS name FROM documents WHERE lang IS NOT NULL)),
toks AS (
  SELECT d.doc_id, k.category_id AS label,
         list_filter(string_split_regex(lower(d.text), '[\s.,]+'), lambda x: x <> '') AS tokens
  FROM documents d JOIN dict k ON d.lang = k.name),
terms AS (
  SELECT doc_id, label, feature, count(*) AS value
  FROM (SELECT doc_id, label, unnest(tokens) AS feature FROM toks) GROUP BY doc_id, label, feature),
vocab AS (
  SELECT feature, row_number() OVER (ORDER BY cnt DESC, feature ASC) AS fid, cnt
  FROM (SELECT feature, count(*) AS cnt FROM terms GROUP BY feature HAVING count(*) >= 31)),
cv AS (SELECT t.doc_id, t.label, v.fid, t.value FROM terms t JOIN vocab v ON t.feature = v.feature),
bv AS (SELECT t.doc_id, t.label, v.fid, CAST(1 AS INTEGER) AS value FROM terms t JOIN vocab v ON t.feature = v.feature),
alld AS (SELECT doc_id, label FROM toks)"""

SQL_IDF = r"""
bdocs AS (SELECT count(DISTINCT doc_id)::DOUBLE AS n FROM bv),
idf AS (SELECT fid - 1 AS fidx, count(*) AS df, ln((SELECT n FROM bdocs) / count(*)) AS idf FROM bv GROUP BY fid)"""

SQL_CHI = r"""
ent AS (SELECT doc_id, label, fid - 1 AS fidx, value FROM cv),
ntot AS (SELECT count(*)::DOUBLE AS n FROM alld),
nl AS (SELECT label, count(*) AS n_l FROM alld GROUP BY label),
obs AS (
  SELECT o.fidx, o.value, o.label, o.o, nl.n_l
  FROM (SELECT fidx, value, label, count(*) AS o FROM ent WHERE value <> 0 GROUP BY fidx, value, label) o
  JOIN nl ON o.label = nl.label),
t1 AS (
  SELECT fidx, sum(q_v / n_v) AS t1
  FROM (SELECT fidx, value, sum(o) AS n_v, sum(o * o / n_l) AS q_v FROM obs GROUP BY fidx, value)
  GROUP BY fidx),
zr AS (
  SELECT fidx, sum(s_fl) AS s_f, sum(s_fl * s_fl / n_l) AS q
  FROM (SELECT fidx, label, n_l, sum(o) AS s_fl FROM obs GROUP BY fidx, label, n_l) GROUP BY fidx),
chi AS (
  SELECT t1.fidx, (SELECT n FROM ntot) * (t1.t1 +
           CASE WHEN (SELECT n FROM ntot) - zr.s_f > 0
                THEN (2 * ((SELECT n FROM ntot) - zr.s_f) - (SELECT n FROM ntot) + zr.q) / ((SELECT n FROM ntot) - zr.s_f)
                ELSE 0.0 END - 1.0) AS chi2
  FROM t1 JOIN zr ON t1.fidx = zr.fidx),
top AS (
  SELECT fidx, row_number() OVER (ORDER BY fidx) - 1 AS new_fidx, chi2
  FROM (SELECT * FROM chi ORDER BY round(chi2, 6) DESC, fidx ASC LIMIT 100)),
rv AS (SELECT e.doc_id, e.label, t.new_fidx AS fidx, e.value FROM ent e JOIN top t ON e.fidx = t.fidx)"""

SQL_NB = rf"""
split AS (SELECT doc_id, label, CASE WHEN {_hash('doc_id', 'split:')} < round(0.3 * 4294967296) THEN 'test' ELSE 'train' END AS part FROM alld),
trd AS (SELECT doc_id, label FROM split WHERE part = 'train'),
ted AS (SELECT doc_id, label FROM split WHERE part = 'test'),
tre AS (SELECT * FROM rv WHERE doc_id IN (SELECT doc_id FROM trd)),
tee AS (SELECT * FROM rv WHERE doc_id IN (SELECT doc_id FROM ted)),
nf AS (SELECT count(*)::DOUBLE AS f FROM top),
pc AS (SELECT label, count(*) AS n_docs FROM trd GROUP BY label),
scf AS (SELECT label, fidx, sum(value) AS s_cf FROM tre GROUP BY label, fidx),
cls AS (
  SELECT pc.label, pc.n_docs, coalesce(sc.s_c, 0) AS s_c
  FROM pc LEFT JOIN (SELECT label, sum(s_cf) AS s_c FROM scf GROUP BY label) sc ON pc.label = sc.label),
tot AS (SELECT sum(n_docs)::DOUBLE AS n, count(*)::DOUBLE AS c FROM pc),
priors AS (
  SELECT label, n_docs,
         ln(n_docs + 0.1::DOUBLE) - ln((SELECT n FROM tot) + (SELECT c FROM tot) * 0.1::DOUBLE) AS pi,
         ln(0.1::DOUBLE) - ln(s_c + (SELECT f FROM nf) * 0.1::DOUBLE) AS theta_unseen
  FROM cls),
theta AS (
  SELECT s.label, s.fidx, ln(s.s_cf + 0.1::DOUBLE) - ln(c.s_c + (SELECT f FROM nf) * 0.1::DOUBLE) AS theta
  FROM scf s JOIN cls c ON s.label = c.label),
scores AS (
  SELECT e.doc_id, p.label AS c, p.pi + sum(e.value * coalesce(t.theta, p.theta_unseen)) AS score
  FROM tee e CROSS JOIN priors p LEFT JOIN theta t ON t.label = p.label AND t.fidx = e.fidx
  GROUP BY e.doc_id, p.label, p.pi),
pred AS (
  SELECT doc_id, c AS prediction
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, c ASC) AS rn FROM scores)
  WHERE rn = 1),
scored AS (
  SELECT ted.doc_id, ted.label, (SELECT count(*) FROM tee WHERE tee.doc_id = ted.doc_id) AS n_entries,
         pred.prediction
  FROM ted LEFT JOIN pred ON ted.doc_id = pred.doc_id)"""


def _bits(text: str, part: str = "0") -> str:
    return f"('0x' || substr(md5({text}), 1 + 8 * ({part}), 8))::BIGINT"


def _forest(trees: int, depth: int, bins: int, seed: int) -> str:
    """CTEs of the forest over tre / trd and its answers for ted / tee, a level at a time."""
    boot = _bits(f"concat_ws(':', 'boot{seed}', t // 4, d.doc_id)", "t % 4")
    times = " + ".join(f"(b >= {x})::INTEGER" for x in POISSON)
    feat = _bits(f"concat_ws(':', 'feat{seed}', tree, node, fidx)")
    out = [f"""
vb0 AS (SELECT fidx, value, count(*) AS n FROM tre WHERE value <> 0 GROUP BY fidx, value),
vb AS (SELECT fidx, value, CASE WHEN count(*) OVER (PARTITION BY fidx) < {bins} THEN row_number() OVER (PARTITION BY fidx ORDER BY value)
              ELSE greatest(1, floor(((sum(n) OVER (PARTITION BY fidx ORDER BY value) - n + (SELECT count(*) FROM trd)
                   - sum(n) OVER (PARTITION BY fidx)) * {bins})::DOUBLE / (SELECT count(*) FROM trd))) END::INTEGER AS bin FROM vb0),
be AS (SELECT e.doc_id, e.fidx, v.bin FROM tre e JOIN vb v ON e.fidx = v.fidx AND e.value = v.value),
take AS (SELECT ceil(sqrt(count(*))) AS k FROM top),
n0 AS (SELECT doc_id, label, tree, {times} AS times, 1 AS node
       FROM (SELECT d.doc_id, d.label, t AS tree, {boot} AS b FROM trd d, range({trees}) r(t)) WHERE {times} > 0),
w0 AS (SELECT doc_id, t AS tree, 1 AS node FROM ted, range({trees}) r(t))"""]
    for k in range(depth):
        out.append(f"""
a{k} AS (SELECT * FROM n{k} WHERE node >= {1 << k}),
all{k} AS (SELECT tree, node, label, sum(times) AS total FROM a{k} GROUP BY ALL),
ch{k} AS (SELECT tree, node, fidx FROM (
    SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY {feat}, fidx) AS k
    FROM (SELECT DISTINCT tree, node FROM a{k}), (SELECT DISTINCT fidx FROM vb)) WHERE k <= (SELECT k FROM take)),
ce{k} AS (SELECT a.tree, a.node, b.fidx, b.bin, a.label, sum(a.times) AS times FROM a{k} a JOIN be b ON a.doc_id = b.doc_id
    JOIN ch{k} c ON c.tree = a.tree AND c.node = a.node AND c.fidx = b.fidx GROUP BY ALL),
at{k} AS (SELECT DISTINCT tree, node, fidx, bin FROM ce{k} UNION SELECT DISTINCT tree, node, fidx, 0 FROM ce{k}),
gr{k} AS (SELECT x.*, total, label, coalesce(times, 0) AS times FROM at{k} x JOIN all{k} USING (tree, node)
    LEFT JOIN ce{k} USING (tree, node, fidx, bin, label)),
z{k} AS (SELECT * EXCLUDE (times), CASE WHEN bin = 0 THEN total - sum(times) OVER (PARTITION BY tree, node, fidx, label) ELSE times END AS times
    FROM gr{k}),
l{k} AS (SELECT *, sum(times) OVER (PARTITION BY tree, node, fidx, label ORDER BY bin) AS lo FROM z{k}),
sc{k} AS (SELECT tree, node, fidx, bin, sum(lo * lo)::DOUBLE / sum(lo)::DOUBLE + sum((total - lo) * (total - lo))::DOUBLE / sum(total - lo)::DOUBLE AS score,
        sum(total * total)::DOUBLE / sum(total)::DOUBLE AS whole
    FROM l{k} GROUP BY tree, node, fidx, bin HAVING sum(lo) > 0 AND sum(total - lo) > 0),
s{k} AS (SELECT tree, node, fidx, bin, coalesce((SELECT max(value) FROM vb WHERE vb.fidx = q.fidx AND vb.bin = q.bin), 0) AS threshold
    FROM (SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY score DESC, fidx, bin) AS r FROM sc{k} WHERE score > whole) q WHERE r = 1),
n{k + 1} AS (SELECT n.doc_id, n.label, n.tree, n.times,
        CASE WHEN s.fidx IS NULL THEN n.node ELSE 2 * n.node + (coalesce(b.bin, 0) > s.bin)::INTEGER END AS node
    FROM n{k} n LEFT JOIN s{k} s ON s.tree = n.tree AND s.node = n.node LEFT JOIN be b ON b.doc_id = n.doc_id AND b.fidx = s.fidx),
w{k + 1} AS (SELECT n.doc_id, n.tree, CASE WHEN s.fidx IS NULL THEN n.node ELSE 2 * n.node + (coalesce(b.value, 0) > s.threshold)::INTEGER END AS node
    FROM w{k} n LEFT JOIN s{k} s ON s.tree = n.tree AND s.node = n.node LEFT JOIN tee b ON b.doc_id = n.doc_id AND b.fidx = s.fidx)""")
    out.append(f"""
leaf AS (SELECT tree, node, label, round(sum(times)::DOUBLE / sum(sum(times)) OVER (PARTITION BY tree, node) * {VOTE})::BIGINT AS votes
    FROM n{depth} GROUP BY tree, node, label),
won AS (SELECT doc_id, label AS prediction, row_number() OVER (PARTITION BY doc_id ORDER BY sum(votes) DESC, label) AS r
    FROM w{depth} JOIN leaf USING (tree, node) GROUP BY doc_id, label)""")
    return ",".join(out)


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts)


ORACLE: dict[str, str] = {
    "word_count": with_ctes(SQL_LINES, r"""
words AS (
  SELECT unnest(CASE WHEN regexp_matches(line, '^\s+$') THEN []::VARCHAR[]
                     ELSE string_split_regex(regexp_replace(line, '\s+$', ''), '\s+') END) AS word
  FROM lines)""") + "\nSELECT word, count(*) AS cnt FROM words GROUP BY word",

    "record_fields": with_ctes(SQL_RECS) + r"""
SELECT page_id,
       substr(list_filter(string_split(line, '`'), lambda x: starts_with(x, 'url='))[-1], 5) AS url,
       substr(list_filter(string_split(line, '`'), lambda x: starts_with(x, 'tit='))[-1], 5) AS tit,
       substr(list_filter(string_split(line, '`'), lambda x: starts_with(x, 'kw='))[-1], 4) AS kw,
       regexp_extract(line, '(?:^|`)url=([^`]*)', 1) AS url_first
FROM precs""",

    "record_pairs": with_ctes(SQL_RECS) + r""",
f AS (SELECT page_id, pos, {jt} AS field
      FROM (SELECT page_id, unnest(parts) AS field, unnest(range(1, len(parts) + 1)) AS pos
            FROM (SELECT page_id, string_split(line, '`') AS parts FROM precs))),
kv AS (SELECT page_id, pos, split_part(field, '=', 1) AS key,
              CASE WHEN strpos(field, '=') > 0 THEN substr(field, strpos(field, '=') + 1) ELSE '' END AS value
       FROM f WHERE field <> '')
SELECT page_id, key, arg_max(value, pos) AS value FROM kv GROUP BY page_id, key""".replace("{jt}", _jtrim("field")),

    "class_count": with_ctes(SQL_DOCS) + "\nSELECT max(category_id) + 1 AS num_classes FROM dict",

    "sample_tokens": with_ctes(SQL_RECS, SQL_RULES, r"""
tk AS (
  SELECT page_id, substr(tag, 1, 4) AS category,
         list_concat(
           list_transform(list_filter(string_split(replace(coalesce(title, ''), '''', ''), ' '),
                                      lambda x: regexp_matches(x, '[^\x00-\x20]')), lambda x: x || '_1'),
           list_transform(list_filter(string_split(replace(coalesce(kw, ''), '''', ''), ' '),
                                      lambda x: regexp_matches(x, '[^\x00-\x20]')), lambda x: x || '_2')) AS t
  FROM best)""") + """
SELECT page_id, category, category || ' ' || array_to_string(t, ' ') AS doc, CAST(len(t) AS INTEGER) AS n_tokens
FROM tk WHERE len(t) > 0""",

    "url_canonical": f"SELECT page_id, {_canon('url')} AS canonical FROM pages",

    "url_site_dirs": f"""
WITH c AS (SELECT page_id, {_canon('url')} AS u FROM pages),
s AS (SELECT page_id, u, length(u) - length(replace(u, '/', '')) AS n FROM c)
SELECT page_id, split_part(CASE WHEN n = 0 THEN u
                               ELSE array_to_string(string_split(u, '/')[1:least(n, 3)], '/') END, '?', 1) AS site_dirs
FROM s""",

    "url_domain_parts": f"""
WITH c AS (SELECT page_id, string_split({_canon('url')}, '/') AS p FROM pages),
t AS (SELECT page_id, {_jtrim('p[1]')} AS p0, coalesce({_jtrim('p[2]')}, '') AS p1,
             coalesce({_jtrim('p[3]')}, '') AS p2 FROM c)
SELECT page_id, CASE WHEN p0 = '' OR starts_with(p0, '.') THEN '' ELSE p0 END AS domain, p1, p2 FROM t""",

    "url_domain_path": f"""
WITH c AS (SELECT page_id, string_split({_canon('url')}, '/') AS p FROM pages),
t AS (SELECT page_id, {_jtrim("split_part(p[1], '?', 1)")} AS domain,
             CASE WHEN len(p) <= 1 THEN ''
                  WHEN len(p) = 2 THEN split_part(split_part(p[2], '?', 1), '#', 1)
                  ELSE split_part(p[2], '#', 1) END AS path FROM c)
SELECT page_id, domain, CASE WHEN starts_with(path, '?') THEN '' ELSE path END AS path FROM t""",

    "site_rollup": f"""
WITH c AS (SELECT string_split({_canon('url')}, '/') AS p FROM pages),
t AS (SELECT {_jtrim('p[1]')} AS p0, coalesce({_jtrim('p[2]')}, '') AS p1 FROM c)
SELECT CASE WHEN p0 = '' OR starts_with(p0, '.') THEN '' ELSE p0 END AS domain,
       count(*) AS pages, count(DISTINCT p1) AS paths
FROM t GROUP BY 1""",

    "classify_url": with_ctes(SQL_RECS, SQL_RULES) + "\nSELECT page_id, url, pattern, tag, category FROM best",

    "path_rules": with_ctes(SQL_RECS, SQL_RULES) + f"""
SELECT page_id, pattern, tag, category
FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pieces DESC, lit_len DESC, ord, pattern, tag) AS k
      FROM hits WHERE ord IN ({', '.join(map(str, PATH_RULES))})) WHERE k = 1""",

    "repeated_fields": with_ctes(SQL_RECS) + """
SELECT page_id, title AS url, 'again' AS kw, url AS url_first FROM recs""",

    "category_counts": with_ctes(SQL_RECS, SQL_RULES) + "\nSELECT category, count(*) AS pages FROM best GROUP BY category",

    "dedupe_title": with_ctes(SQL_RECS, SQL_RULES) + """
SELECT title, min(page_id) AS page_id, arg_min(url, page_id) AS url, arg_min(category, page_id) AS category
FROM best GROUP BY title""",

    "hash_sample": f"SELECT doc_id, lang FROM documents WHERE {_hash('doc_id', 's1:')} < round(0.1 * 4294967296)",

    "two_stage_sample": f"""
SELECT doc_id, lang FROM documents
WHERE {_hash('doc_id', 's1:')} < round(0.1 * 4294967296) AND {_hash('doc_id', 's2:')} < round(0.1 * 4294967296)""",

    "train_test_split": f"""
SELECT doc_id, CASE WHEN {_hash('doc_id', 'split:')} < round(0.3 * 4294967296) THEN 'test' ELSE 'train' END AS part FROM documents""",

    "label_dictionary": with_ctes(SQL_DOCS) + "\nSELECT name, category_id FROM dict",

    "whitelist_filter": with_ctes(SQL_DOCS) + "\nSELECT doc_id, label FROM alld",

    "vocabulary": with_ctes(SQL_DOCS) + "\nSELECT feature, fid, cnt FROM vocab",

    "binary_vectors": with_ctes(SQL_DOCS) + "\nSELECT doc_id, label, fid, value FROM bv",

    "count_vectors": with_ctes(SQL_DOCS) + "\nSELECT doc_id, label, fid, value FROM cv",

    "doc_frequency": with_ctes(SQL_DOCS) + "\nSELECT fid - 1 AS fidx, count(*) AS df FROM bv GROUP BY fid",

    "idf": with_ctes(SQL_DOCS, SQL_IDF) + "\nSELECT fidx, df, round(idf, 10) AS idf FROM idf",

    "tfidf_vectors": with_ctes(SQL_DOCS, SQL_IDF) + """
SELECT b.doc_id, b.label, b.fid, round((1.0::DOUBLE / len(t.tokens)) * i.idf, 10) AS value
FROM bv b JOIN toks t ON b.doc_id = t.doc_id JOIN idf i ON b.fid - 1 = i.fidx""",

    "chi_square": with_ctes(SQL_DOCS, SQL_CHI) + "\nSELECT fidx, round(chi2, 6) AS chi2 FROM chi",

    "top_features": with_ctes(SQL_DOCS, SQL_CHI) + "\nSELECT fidx, new_fidx, round(chi2, 6) AS chi2 FROM top",

    "reindexed_vectors": with_ctes(SQL_DOCS, SQL_CHI) + "\nSELECT doc_id, label, fidx, value FROM rv",

    "nb_priors": with_ctes(SQL_DOCS, SQL_CHI, SQL_NB) + """
SELECT label, n_docs, round(pi, 10) AS pi, round(theta_unseen, 10) AS theta_unseen FROM priors""",

    "nb_theta": with_ctes(SQL_DOCS, SQL_CHI, SQL_NB) + "\nSELECT label, fidx, round(theta, 10) AS theta FROM theta",

    "nb_predict": with_ctes(SQL_DOCS, SQL_CHI, SQL_NB) + """
SELECT doc_id, CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction
FROM scored WHERE n_entries > 0""",

    "holdout_metrics": with_ctes(SQL_DOCS, SQL_CHI, SQL_NB) + """,
m AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE n_entries > 0) AS classified,
         count(*) FILTER (WHERE n_entries > 0 AND prediction <> label) AS errors
  FROM scored),
r AS (SELECT *, CASE WHEN classified = 0 THEN NULL ELSE (classified - errors)::DOUBLE / classified END AS acc,
             CASE WHEN total = 0 THEN NULL ELSE (classified - errors)::DOUBLE / total END AS rec FROM m)
SELECT total, classified, errors,
       round(CASE WHEN classified = 0 THEN NULL ELSE errors::DOUBLE / classified END, 10) AS test_err,
       round(acc, 10) AS test_acc, round(rec, 10) AS test_rec,
       round(CASE WHEN acc = 0 OR rec = 0 THEN NULL ELSE 2.0::DOUBLE / (1.0::DOUBLE / acc + 1.0::DOUBLE / rec) END, 10) AS f1
FROM r""",

    "rf_predict": with_ctes(SQL_DOCS, SQL_CHI, SQL_NB, _forest(RF_TREES, RF_DEPTH, RF_BINS, RF_SEED)) + """
SELECT ted.doc_id, CAST(ted.label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction
FROM ted JOIN won ON ted.doc_id = won.doc_id AND r = 1 WHERE ted.doc_id IN (SELECT doc_id FROM tee)""",

    "rf_stump": with_ctes(SQL_DOCS, SQL_CHI, SQL_NB, """
sides AS (
  SELECT t.new_fidx AS f, d.label, count(e.doc_id) AS hi, count(*) - count(e.doc_id) AS lo
  FROM top t CROSS JOIN trd d LEFT JOIN tre e ON e.doc_id = d.doc_id AND e.fidx = t.new_fidx
  GROUP BY t.new_fidx, d.label),
weights AS (
  SELECT f, sum(hi) AS n_hi, sum(lo) AS n_lo,
         sum(hi) - sum(hi * hi)::DOUBLE / greatest(sum(hi), 1) + sum(lo) - sum(lo * lo)::DOUBLE / greatest(sum(lo), 1) AS gini,
         arg_max(label, hi * 1000 - label) AS high, arg_max(label, lo * 1000 - label) AS low,
         arg_max(label, (hi + lo) * 1000 - label) AS all_of
  FROM sides GROUP BY f),
split1 AS (SELECT * FROM weights WHERE n_hi > 0 AND n_lo > 0 ORDER BY round(gini, 6), f LIMIT 1)""") + """
SELECT ted.doc_id, CAST(ted.label AS DOUBLE) AS label, CAST(CASE WHEN e.doc_id IS NULL THEN low ELSE high END AS DOUBLE) AS prediction
FROM ted CROSS JOIN split1 s LEFT JOIN tee e ON e.doc_id = ted.doc_id AND e.fidx = s.f""",

    "token_dedupe": with_ctes(SQL_DOCS) + "\nSELECT DISTINCT doc_id, unnest(tokens) AS token FROM toks",

    "key_join": """
WITH keys AS (SELECT CAST(c_custkey AS VARCHAR) AS key FROM customer
              UNION ALL SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT o.key, o.value
FROM (SELECT CAST(o_custkey AS VARCHAR) AS key, CAST(o_orderkey AS VARCHAR) AS value FROM orders) o
JOIN keys k ON o.key = k.key""",

    "identity": rf"""
WITH u AS (SELECT event_id, user_id,
                  CASE WHEN user_id % 4 = 0 THEN 'null' WHEN user_id % 4 = 1 THEN ' ' ELSE 'u' || user_id END AS uid,
                  CASE WHEN user_id % 3 = 0 THEN 'im' || user_id ELSE '' END AS imei,
                  CASE WHEN user_id % 5 = 0 THEN ' s' || user_id || ' ' ELSE 'NULL' END AS snid,
                  CASE WHEN user_id % 2 = 0 THEN 'a-' || user_id || '-z' ELSE 'b-' || user_id END AS sn,
                  event_type FROM events),
l AS (SELECT event_id, 'uid=' || uid || '`imei=' || imei || '`snid=' || snid || '`sn=' || sn || '`type=' || event_type AS line FROM u),
f AS (SELECT event_id,
             {_jtrim("regexp_extract(line, '(?:^|`)uid=([^`]*)', 1)")} AS v1,
             {_jtrim("regexp_extract(line, '(?:^|`)imei=([^`]*)', 1)")} AS v2,
             {_jtrim("regexp_extract(line, '(?:^|`)snid=([^`]*)', 1)")} AS v3,
             {_jtrim("regexp_extract(line, '(?:^|`)sn=([^`]*)', 1)")} AS sn FROM l)
SELECT event_id,
       CASE WHEN v1 <> '' AND lower(v1) <> 'null' THEN v1
            WHEN v2 <> '' AND lower(v2) <> 'null' THEN v2
            WHEN v3 <> '' AND lower(v3) <> 'null' THEN v3
            WHEN sn <> '' AND len(string_split(rtrim(sn, '-'), '-')) = 3 THEN string_split(rtrim(sn, '-'), '-')[2]
            ELSE '' END AS identity
FROM f""",

    "active_days": """
SELECT user_id, CAST(bit_or(CAST(1 AS INTEGER) << (day(ts) - 1)) AS INTEGER) AS bitmap,
       CAST(bit_count(bit_or(CAST(1 AS INTEGER) << (day(ts) - 1))) AS INTEGER) AS active_days
FROM events GROUP BY user_id""",

    "day_boundary": """
SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, epoch_ms(date_trunc('day', ts)) AS day_start_ms,
       epoch_ms(date_trunc('day', ts) - INTERVAL 7 DAY) AS week_before_ms
FROM events""",

    "libsvm_text": with_ctes(SQL_DOCS) + """
SELECT d.doc_id, CAST(d.label AS VARCHAR) || ' ' ||
       coalesce(string_agg(CAST(c.fid AS VARCHAR) || ':' || CAST(c.value AS VARCHAR), ' ' ORDER BY c.fid), '') AS line
FROM alld d LEFT JOIN cv c ON d.doc_id = c.doc_id
GROUP BY d.doc_id, d.label""",
}

ORACLE["nb_table_predict"] = ORACLE["nb_predict"]  # the same answers, with and without vectors
ORACLE["table_metrics"] = ORACLE["holdout_metrics"]
ORACLE["merged_statistics"] = with_ctes(SQL_DOCS, SQL_CHI) + """
SELECT v.feature, v.fid - 1 AS fidx, v.cnt, f.df, round(ln((SELECT n FROM ntot) / f.df), 10) AS idf, round(chi.chi2, 6) AS chi2
FROM vocab v JOIN (SELECT fid, count(*) AS df FROM bv GROUP BY fid) f ON v.fid = f.fid JOIN chi ON chi.fidx = v.fid - 1"""
ORACLE["merged_theta"] = with_ctes(SQL_DOCS) + """,
s AS (SELECT label, fid - 1 AS fidx, sum(value) AS s_cf FROM cv GROUP BY label, fid),
c AS (SELECT label, sum(s_cf) AS s_c FROM s GROUP BY label)
SELECT label, fidx, round(ln(s_cf + 0.1::DOUBLE) - ln(s_c + (SELECT count(*) FROM vocab) * 0.1::DOUBLE), 10) AS theta FROM s JOIN c USING (label)"""
ORACLE["grown_dictionary"] = with_ctes(SQL_DOCS) + """,
day1 AS (SELECT feature, count(*) AS cnt FROM terms WHERE doc_id % 3 = 0 GROUP BY feature HAVING count(*) >= 31),
old AS (SELECT feature, row_number() OVER (ORDER BY cnt DESC, feature) AS fid FROM day1)
SELECT feature, fid FROM old
UNION ALL
SELECT feature, row_number() OVER (ORDER BY cnt DESC, feature) + (SELECT coalesce(max(fid), 0) FROM old) AS fid
FROM vocab WHERE feature NOT IN (SELECT feature FROM old)"""
