"""Registered queries over files: text written from the driver tables by the sinks into
the shared folder, read back by the sources, and the jobs run on it.

Files hold what a hand-kept file holds: repeated keys, bad rows, double quotes,
label-only lines, records without a rule, without tokens, with a repeated field.
"""

from __future__ import annotations

from pyspark.ml.classification import NaiveBayesModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.functions.records import last_field
from loomtext.functions.text import suffixed_tokens
from loomtext.operators.bayes import load_bayes
from loomtext.operators.classify import classify
from loomtext.operators.vectors import binary_vectors, count_vectors, counted_instances, distinct_tokens, with_term_counts
from loomtext.operators.vocab import category_dictionary, vocabulary
from loomtext.operators.wordcount import blob_lines
from loomtext.plans import corpus, jobs
from loomtext.plans.catalog import SQL_CHI, SQL_DOCS, SQL_LINES, SQL_NB, SQL_RECS, SQL_RULES, Query, with_ctes
from loomtext.session import scratch_path
from loomtext.sinks.text import write_dictionary, write_libsvm, write_lines
from loomtext.sources.tables import table
from loomtext.sources.text import (identified_lines, instance_documents, parse_counted_instances, parse_libsvm,
                                   read_category_dictionary, read_feature_dictionary, read_idf_model, read_lines,
                                   read_rule_files)
from loomtext.streaming.labelling import start_labelling
from loomtext.streaming.titles import current_records, start_one_per_title

FORMAT_MIN_COUNT = 3  # of the formatting query's vocabulary
NO_RULE = "zz://none/"  # URLs that hold no rule


def _written(df: DataFrame, name: str, line, order: str | None = None) -> str:
    """Folder of text lines (in ``order``, so that file order is that order)."""
    path = scratch_path(df.sparkSession, name)
    write_lines((df.orderBy(order) if order else df).select(line.alias("line")), path)
    return path


def q_file_lines(spark, sf):
    """The lines of all texts as files, counted when read back."""
    lines = blob_lines(table(spark, sf, "documents").select("text"), "text")
    path = _written(lines, "file-lines", F.col("value"))
    return read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def q_category_file(spark, sf):
    """Two files of ``id`name`` lines, blanks around both, bad ids, lines of one field."""
    docs = table(spark, sf, "documents").select("doc_id", F.concat_ws("-", "lang", F.col("doc_id") % 97).alias("name"))
    number = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("x"), "doc_id")).otherwise(F.col("doc_id").cast("string"))
    line = F.when(F.col("doc_id") % 11 == 0, number).otherwise(F.concat(F.lit(" "), number, F.lit(" ` "), "name", F.lit("\t")))
    one = _written(docs, "categories-1", line, "doc_id")
    two = _written(docs.where("doc_id % 5 = 0"), "categories-2", F.concat_ws("`", F.col("doc_id") + 1000000, "name"), "doc_id")
    return read_category_dictionary(spark, [one, two])


def _feature_files(spark, vocab):
    """K3 + O3: the vocabulary as a dictionary, and a later file with some new ids and
    lines of one and three fields."""
    path = scratch_path(spark, "features")
    write_dictionary(vocab, path + "-1", ("feature", "fid"), "fid")
    more = vocab.where("fid % 10 = 0")
    line = F.concat_ws("\t", "feature", F.col("fid") + 1000000)
    odd = F.when(F.col("fid") % 20 == 0, F.concat(line, F.lit("\textra"))).when(F.col("fid") % 30 == 0, F.col("feature"))
    write_lines(more.select(F.coalesce(odd, line).alias("line")), path + "-2")
    return [path + "-1", path + "-2"]


def _documents(spark, sf):
    docs, _ = corpus.labelled_docs(spark, sf)
    return docs


def q_feature_file(spark, sf):
    """The dictionary read back from two files."""
    vocab = vocabulary(distinct_tokens(_documents(spark, sf)).withColumnRenamed("token", "feature"))
    return read_feature_dictionary(spark, _feature_files(spark, vocab))


def q_libsvm_file(spark, sf):
    """Count vectors written and parsed; documents without entries have fidx -1."""
    docs = _documents(spark, sf)
    inst = counted_instances(docs)
    vocab = vocabulary(distinct_tokens(docs).withColumnRenamed("token", "feature"))  # the same rows, not yet counted
    path = scratch_path(spark, "libsvm")
    write_libsvm(count_vectors(inst, vocab, one_row_per_feature=True), docs, path)
    entries, read = parse_libsvm(read_lines(spark, path))
    per = entries.groupBy("label", "fidx", "value").agg(F.count(F.lit(1)).alias("n"))
    alone = read.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return per.unionByName(alone.select("label", F.lit(-1).cast("long").alias("fidx"), F.lit(0.0).alias("value"), "n"))


def q_idf_file(spark, sf):
    """The IDF job over libsvm files with label-only lines beside the
    documents' own."""
    docs = _documents(spark, sf)
    vocab = vocabulary(distinct_tokens(docs).withColumnRenamed("token", "feature"))
    path = scratch_path(spark, "idf")
    alone = docs.where("doc_id % 9 = 0").select((-1 - F.col("doc_id")).alias("doc_id"), "label")
    write_libsvm(binary_vectors(docs, vocab), docs.select("doc_id", "label").unionByName(alone), path + "-libsvm")
    jobs.run_idf(spark, path + "-libsvm", path)
    return read_idf_model(spark, path).select("fidx", F.round("idf", 10).alias("idf"))


def _instance_file(spark, sf):
    """Counted instances as lines ``lang feature:count ...``: every fifth document has also a
    value that is no number; for every ninth there is a second line, of its label only."""
    docs = corpus.token_docs(spark, sf).where("lang is not null").withColumnRenamed("lang", "label")
    # the items of a row are made in the row; rows that share an id share their items
    items = with_term_counts(docs, "tokens", "items").select("doc_id", F.transform(
        "items", lambda x: F.concat_ws(":", x["token"], x["tf"])).alias("items"))
    items = items.groupBy("doc_id").agg(F.sort_array(F.flatten(F.collect_list("items"))).alias("items"))
    full = docs.select("doc_id", "label").join(items, "doc_id", "left")
    bad = F.when(F.col("doc_id") % 5 == 0, F.lit("ur:l:x"))
    alone = table(spark, sf, "documents").where("doc_id % 9 = 0 and lang is not null").select(F.col("lang").alias("line"))
    lines = full.select(F.concat(F.col("label"), F.lit(" "), F.concat_ws(" ", "items", bad)).alias("line"))
    return _written(lines.unionByName(alone), "instances", F.col("line"))


def q_instances_file(spark, sf):
    """Per label and feature the rows, values and bad values; label-only lines and all
    others count as documents (feature '')."""
    lines = identified_lines(read_lines(spark, _instance_file(spark, sf)))
    inst = parse_counted_instances(lines).groupBy("label", "feature").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("value"), F.lit(0)).cast("long").alias("total"),
        F.count_if(F.col("value").isNull()).alias("bad"))
    docs = instance_documents(lines).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    return inst.unionByName(docs.select("label", F.lit("").alias("feature"), "n", zero.alias("total"), zero.alias("bad")))


def _training(spark, sf, **options):
    """The training job on instance files, with a category file that lacks the last
    language, fitted on all rows; its output folder."""
    docs = table(spark, sf, "documents").select("lang").where("lang is not null")
    out = scratch_path(spark, "training")
    instances = _instance_file(spark, sf)
    kept = docs.where(F.col("lang") < docs.agg(F.max("lang")).scalar())
    cats = _written(category_dictionary(kept, "lang"), "training-categories", F.concat_ws("`", "category_id", "name"))
    jobs.run_training(spark, cats, instances, out, fit_on_all=True, **options)
    return out


def q_training_job(spark, sf):
    """The training job with selection, naive Bayes on sparse vectors; the saved
    model loaded again."""
    out = _training(spark, sf, model="nb")
    theta = NaiveBayesModel.load(f"{out}/nb_model").theta.toArray()  # classes x selected features
    rows = [(c, f, round(float(x), 8)) for c, row in enumerate(theta) for f, x in enumerate(row)]
    return spark.createDataFrame(rows, "label int, fidx long, theta double")


def q_training_all_features(spark, sf):
    """M9, K5 without selection (num_feats 0): the tables over the whole vocabulary, loaded again."""
    model = load_bayes(spark, _training(spark, sf, model="nb_table", num_feats=0) + "/nb_table_model")
    return model.theta.select("label", "fidx", F.round("theta", 8).alias("theta"))


def _log_lines(spark, sf):
    """Pages as log lines: every tenth with a URL that holds no rule, every ninth without
    title and keywords, every fourth with its URL field given twice."""
    recs = corpus.page_records(table(spark, sf, "pages"))
    url = F.when(F.col("page_id") % 10 == 0, F.concat(F.lit(NO_RULE), "page_id")).otherwise(F.col("url"))
    blank = F.col("page_id") % 9 == 0
    first = F.when(F.col("page_id") % 4 == 0, F.lit("url=http://old.example.com/`")).otherwise(F.lit(""))
    return recs.select("page_id", F.concat(first, F.lit("url="), url, F.lit("`tit="), F.when(blank, "").otherwise(F.col("title")),
                                           F.lit("`kw="), F.when(blank, "").otherwise(F.col("kw"))).alias("line"))


def _rule_paths(spark, sf):
    """The seed rules and the host rules as two files, lines without a rule between."""
    rules = corpus.page_rules(spark, table(spark, sf, "pages"))
    line = F.concat("pattern", F.lit("``"), "tag")
    plain = F.when(F.col("ord") % 3 == 0, F.concat(F.lit("# next\n"), line)).otherwise(line)
    base = F.col("ord") < corpus.HOST_RULE_ORD_BASE
    return [_written(rules.where(c), f"rules-{i}", plain, "ord") for i, c in enumerate((base, ~base))]


def q_rule_files(spark, sf):
    """Pages labelled by rules read from files."""
    recs = table(spark, sf, "pages").select("page_id", "url")
    return classify(recs, read_rule_files(spark, _rule_paths(spark, sf))).select("page_id", "url", "pattern", "tag")


def q_labelling_job(spark, sf):
    """The labelling job on log files (S1, S3, J1, F1, K4, A6, K1), nothing sampled away:
    labelled records per (url, tit, tag) and whether the title survives."""
    logs = _written(_log_lines(spark, sf), "logs", F.col("line"))
    out = scratch_path(spark, "labelling")
    jobs.run_labelling(spark, logs, corpus.page_rules(spark, table(spark, sf, "pages")), out + "-labelled", out + "-sample", 1.0, 1.0)
    labelled = spark.read.parquet(out + "-labelled")
    v = F.col("value")
    titles = read_lines(spark, out + "-sample").groupBy(last_field(v, "tit").alias("tit")).agg(F.count(F.lit(1)).alias("kept"))
    return labelled.groupBy("url", "tit", "tag").agg(F.count(F.lit(1)).alias("n")).join(titles, "tit")


def q_formatting_job(spark, sf):
    """Labelled log files and a dictionary file in, binary
    libsvm files out; entries per (label, fidx)."""
    recs = _log_lines(spark, sf).select("page_id", "line", last_field(F.col("line"), "url").alias("url"))
    labelled = classify(recs, corpus.page_rules(spark, table(spark, sf, "pages")))
    line = F.concat(F.lit("category="), "tag", F.lit("`"), "line")
    logs = _written(labelled, "labelled-lines", line)
    tokens = F.concat(suffixed_tokens(last_field(F.col("line"), "tit"), "_1"), suffixed_tokens(last_field(F.col("line"), "kw"), "_2"))
    docs = labelled.select(F.col("page_id").alias("doc_id"), F.lit(0).alias("label"), tokens.alias("tokens"))
    vocab = vocabulary(distinct_tokens(docs).withColumnRenamed("token", "feature"), FORMAT_MIN_COUNT)
    path = scratch_path(spark, "formatted")
    write_dictionary(vocab, path + "-features", ("feature", "fid"), "fid")
    jobs.run_binary_libsvm(spark, logs, path + "-features", path)
    entries, _ = parse_libsvm(read_lines(spark, path))
    return entries.groupBy("label", "fidx").agg(F.count(F.lit(1)).alias("n"))


HOURS = 4  # folders of logs that the stream query deals the records into


def q_labelling_stream(spark, sf):
    """A6 over a stream (S1, S3, J1, F1): the log lines arrive in hours, the first one twice;
    they are labelled as they land, and a second stream keeps one record per title."""
    logs, path = _log_lines(spark, sf), scratch_path(spark, "labelling-stream")
    for hour in range(HOURS):
        write_lines(logs.where(F.col("page_id") % HOURS == hour), f"{path}/logs/hour-{hour}")
    write_lines(logs.where(F.col("page_id") % HOURS == 0), f"{path}/logs/hour-{HOURS}")
    rules = corpus.page_rules(spark, table(spark, sf, "pages"))
    start_labelling(spark, f"{path}/logs/*", rules, f"{path}/labelled", f"{path}/offsets-1", once=True).awaitTermination()
    start_one_per_title(spark, f"{path}/labelled", f"{path}/titles", f"{path}/offsets-2", 1.0, once=True).awaitTermination()
    return current_records(spark, f"{path}/titles")


QUERIES: dict[str, Query] = {
    "labelling_stream": q_labelling_stream,
    "file_lines": q_file_lines,
    "category_file": q_category_file,
    "feature_file": q_feature_file,
    "libsvm_file": q_libsvm_file,
    "idf_file": q_idf_file,
    "instances_file": q_instances_file,
    "training_job": q_training_job,
    "training_all_features": q_training_all_features,
    "rule_files": q_rule_files,
    "labelling_job": q_labelling_job,
    "formatting_job": q_formatting_job,
}

# ---------------------------------------------------------------------------------------
# Oracle SQL (DuckDB)

_LOG_RECS = rf"""
recs AS (
  SELECT page_id, CASE WHEN page_id % 10 = 0 THEN '{NO_RULE}' || page_id ELSE url END AS url,
         CASE WHEN page_id % 9 = 0 THEN '' ELSE regexp_extract(html, '<title>(.*?)</title>', 1) END AS title,
         CASE WHEN page_id % 9 = 0 THEN '' ELSE
           array_to_string(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1), ' ') END AS kw
  FROM pages)"""

# as the lines of the files: for every ninth document another one with its label only
_WITH_ALONE = SQL_DOCS.replace("alld AS (SELECT doc_id, label FROM toks)", """alld AS (
  SELECT doc_id, label FROM toks UNION ALL SELECT -1 - doc_id, label FROM toks WHERE doc_id % 9 = 0)""")
_TRAINING = _WITH_ALONE.replace("ON d.lang = k.name", "ON d.lang = k.name WHERE d.lang < (SELECT max(lang) FROM documents)")
_NB_ALL = SQL_NB.replace("FROM split WHERE part = 'train'", "FROM split")

ORACLE: dict[str, str] = {
    "file_lines": with_ctes(SQL_LINES) + "\nSELECT line AS value, count(*) AS n FROM lines GROUP BY line",

    "category_file": """
WITH l AS (
  SELECT 0 AS f, doc_id, doc_id AS id, lang FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0
  UNION ALL
  SELECT 1, doc_id, doc_id + 1000000, lang FROM documents WHERE doc_id % 5 = 0)
SELECT concat_ws('-', lang, CAST(doc_id % 97 AS VARCHAR)) AS name,
       CAST(arg_max(id, f * 1000000000000 + doc_id) AS INTEGER) AS category_id
FROM l GROUP BY 1""",

    "feature_file": with_ctes(SQL_DOCS) + """
SELECT feature, CASE WHEN fid % 10 = 0 AND fid % 20 <> 0 AND fid % 30 <> 0 THEN fid + 1000000 ELSE fid END AS fid
FROM vocab""",

    "libsvm_file": with_ctes(SQL_DOCS) + """
SELECT CAST(label AS DOUBLE) AS label, fid - 1 AS fidx, CAST(value AS DOUBLE) AS value, count(*) AS n
FROM cv GROUP BY 1, 2, 3
UNION ALL
SELECT CAST(label AS DOUBLE), -1, 0.0, count(*) FROM alld GROUP BY label""",

    "idf_file": with_ctes(_WITH_ALONE) + """
SELECT fid - 1 AS fidx, round(ln((SELECT count(*) FROM alld)::DOUBLE / count(*)), 10) AS idf
FROM bv GROUP BY fid""",

    "instances_file": with_ctes(SQL_DOCS) + """
SELECT k.name AS label, feature, count(*) AS n, CAST(sum(value) AS BIGINT) AS total, 0::BIGINT AS bad
FROM terms JOIN dict k ON terms.label = k.category_id GROUP BY 1, 2
UNION ALL
SELECT lang, 'ur:l', count(*), 0, count(*) FROM documents WHERE lang IS NOT NULL AND doc_id % 5 = 0 GROUP BY lang
UNION ALL
SELECT lang, '', count(*) + count(*) FILTER (doc_id % 9 = 0), 0, 0 FROM documents WHERE lang IS NOT NULL GROUP BY lang""",

    "training_job": with_ctes(_TRAINING, SQL_CHI, _NB_ALL) + """
SELECT p.label, t.new_fidx AS fidx, round(coalesce(h.theta, p.theta_unseen), 8) AS theta
FROM priors p CROSS JOIN top t LEFT JOIN theta h ON h.label = p.label AND h.fidx = t.new_fidx""",

    "training_all_features": with_ctes(_TRAINING, SQL_CHI, _NB_ALL.replace("FROM rv", "FROM ent").replace(
        "SELECT count(*)::DOUBLE AS f FROM top", "SELECT max(fidx)::DOUBLE + 1 AS f FROM ent")) + """
SELECT label, fidx, round(theta, 8) AS theta FROM theta""",

    "rule_files": with_ctes(SQL_RECS, SQL_RULES) + "\nSELECT page_id, url, pattern, tag FROM best",

    "labelling_job": with_ctes(_LOG_RECS, SQL_RULES) + """
SELECT url, title AS tit, tag, count(*) AS n, 1::BIGINT AS kept FROM best GROUP BY url, title, tag""",

    "labelling_stream": with_ctes(_LOG_RECS, SQL_RULES) + """
, l AS (
  SELECT title, tag, CASE WHEN page_id % 4 = 0 THEN 'url=http://old.example.com/`' ELSE '' END
                     || 'url=' || url || '`tit=' || title || '`kw=' || kw AS line FROM best)
SELECT title AS tit, min(line) AS line, arg_min(tag, line) AS tag FROM l GROUP BY title""",

    "formatting_job": with_ctes(_LOG_RECS, SQL_RULES, r"""
tk AS (
  SELECT page_id, TRY_CAST(substr(tag, 1, 4) AS INTEGER) AS label, unnest(list_distinct(list_concat(
           list_transform(list_filter(string_split(replace(title, '''', ''), ' '),
                                      lambda x: regexp_matches(x, '[^\x00-\x20]')), lambda x: x || '_1'),
           list_transform(list_filter(string_split(replace(kw, '''', ''), ' '),
                                      lambda x: regexp_matches(x, '[^\x00-\x20]')), lambda x: x || '_2')))) AS feature
  FROM best),
fv AS (
  SELECT feature, row_number() OVER (ORDER BY cnt DESC, feature ASC) - 1 AS fidx
  FROM (SELECT feature, count(*) AS cnt FROM tk GROUP BY feature HAVING count(*) >= {min}))""".replace("{min}", str(FORMAT_MIN_COUNT))) + """
SELECT CAST(label AS DOUBLE) AS label, fidx, count(*) AS n
FROM tk JOIN fv ON tk.feature = fv.feature WHERE label IS NOT NULL GROUP BY 1, 2""",
}
