"""End-to-end jobs over files: labelling, formatting, IDF, training, word count.

Each job reads its inputs with ``loomtext.sources``, composes the lazy operators and
writes with ``loomtext.sinks``. Stage outputs that later stages read more than once
are written to the shared checkpoint folder first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions.records import last_field
from loomtext.functions.text import suffixed_tokens
from loomtext.operators.classify import classify
from loomtext.operators.bayes import Bayes, load_bayes, predict_bayes
from loomtext.operators.evaluate import holdout_metrics
from loomtext.operators.forest import grow_forest, load_forest, predict_forest
from loomtext.operators.models import (DEFAULT_BINS, DEFAULT_DEPTH, DEFAULT_SMOOTHING, DEFAULT_TREES,
                                       fit_naive_bayes, nb_tables, save_model, to_vectors)
from loomtext.operators.sampling import one_per_title, picked_lines, split_column
from loomtext.operators.select import DEFAULT_TOP_K, chi_square, reindex, top_features
from loomtext.operators.vectors import binary_vectors, count_vectors, grouped_entries, tfidf_vectors
from loomtext.operators.vocab import MIN_COUNT, vocabulary, with_category_id
from loomtext.operators.weights import idf
from loomtext.operators.wordcount import word_count
from loomtext.plans.stages import Stages
from loomtext.sinks.text import grouped_libsvm_lines, write_dictionary, write_libsvm, write_lines, write_table
from loomtext.sources.text import (identified_lines, instance_documents, parse_counted_instances, parse_libsvm,
                                   read_category_dictionary, read_feature_dictionary, read_idf_model, read_lines,
                                   sampled_lines)


def run_word_count(spark: SparkSession, input_path: str, output_path: str) -> None:
    """Word count of text files, written as ``word TAB count`` lines."""
    counts = word_count(read_lines(spark, input_path))
    write_lines(counts.select(F.concat_ws("\t", "word", F.col("cnt").cast("string")).alias("line")), output_path)


def browse_records(lines: DataFrame) -> DataFrame:
    """Raw log lines with an id from their content -> ``(rec_id, line, url, tit, kw)``."""
    v = F.col("value")
    with_id = identified_lines(lines, "rec_id")
    return with_id.select("rec_id", v.alias("line"), last_field(v, "url").alias("url"),
                          last_field(v, "tit").alias("tit"), last_field(v, "kw").alias("kw"))


def run_labelling(spark: SparkSession, logs: str | list[str], rules: DataFrame, labelled_out: str, sample_out: str,
                  first: float = 0.1, second: float = 0.1) -> None:
    """Sample the logs, label by URL rules, keep a second sample, one record per title.

    The first sample is a filter on the raw lines; only what it keeps is shuffled for its
    ids. Samples and survivors depend on the lines alone, not on files or splits. The
    labelled table is written once and the second stage reads it back, so labelling
    runs once.
    """
    recs = browse_records(sampled_lines(read_lines(spark, logs), first))
    labelled = classify(recs, rules)
    write_table(labelled.withColumn("labelled", labelled_line()), labelled_out)
    one = one_per_title(picked_lines(spark.read.parquet(labelled_out), second))
    write_lines(one.select(labelled_line().alias("labelled")), sample_out, column="labelled")


def labelled_line():
    """The line of a labelled sample: ``category=TAG`LINE``."""
    return F.concat(F.lit("category="), F.col("tag"), F.lit("`"), F.col("line"))


def labelled_token_docs(lines: DataFrame) -> DataFrame:
    """P4 + P5 + F2: labelled lines ``category=NNNN`...`` -> ``(doc_id, label, tokens)``
    (category = the 4 characters after ``category=``; tokens = title tokens then keyword
    tokens); documents without a category or without any token are dropped."""
    v = F.col("value")
    cate = F.regexp_extract(v, "category=(.{4})", 1)
    toks = F.concat(suffixed_tokens(last_field(v, "tit"), "_1"), suffixed_tokens(last_field(v, "kw"), "_2"))
    docs = identified_lines(lines).select(
        "doc_id", (cate).try_cast("int").alias("label"), toks.alias("tokens"))
    return docs.where(F.col("label").isNotNull() & (F.size("tokens") > 0))


def run_binary_libsvm(spark: SparkSession, labelled: str, dictionary: str, out: str) -> None:
    """Labelled samples -> binary libsvm with the feature dictionary (M1)."""
    docs = labelled_token_docs(read_lines(spark, labelled))
    entries = binary_vectors(docs, read_feature_dictionary(spark, dictionary))
    write_libsvm(entries, entries.select("doc_id", "label").distinct(), out, "%d")


def run_tfidf_libsvm(spark: SparkSession, labelled: str, dictionary: str, idf_model: str, out: str) -> None:
    """Labelled samples -> TF-IDF libsvm (M2), values with 6 decimals."""
    docs = labelled_token_docs(read_lines(spark, labelled))
    entries = tfidf_vectors(docs, read_feature_dictionary(spark, dictionary), read_idf_model(spark, idf_model))
    write_libsvm(entries, entries.select("doc_id", "label").distinct(), out, "%f")


def run_idf(spark: SparkSession, libsvm: str, out: str) -> None:
    """libsvm -> ``fidx TAB idf`` (A3, A4)."""
    entries, docs = parse_libsvm(read_lines(spark, libsvm))
    weights = idf(entries.withColumn("fid", F.col("fidx") + 1), docs)
    write_dictionary(weights.select("fidx", "idf"), out, ("fidx", "idf"), "fidx")


@dataclass
class TrainResult:
    num_features: int
    metrics: dict


def run_training(spark: SparkSession, categories: str, instances: str, out: str, model: str = "nb,rf",
                 num_feats: int = DEFAULT_TOP_K, num_trees: int = DEFAULT_TREES, smoothing: float = DEFAULT_SMOOTHING,
                 fit_on_all: bool = False, seed: int = 7, resume: str | None = None) -> dict[str, TrainResult]:
    """M9: category filter, vocabulary, libsvm, chi-square selection (none for
    ``num_feats`` <= 0), then the models named by ``model`` with holdout metrics: ``nb``
    (naive Bayes on sparse vectors), ``nb_table`` (the same on tables), ``rf`` (random
    forest on tables). Every artefact goes under ``out``; models are asked as loaded.

    With ``resume`` (a shared folder) the stages are kept there under their inputs and
    parameters: a run that was stopped goes on after its last finished stage, and a run
    with another model or selection starts from the same vocabulary and entries."""
    keep = Stages(spark, resume, [categories, instances]).keep
    cats = read_category_dictionary(spark, categories)
    lines = keep("instance-lines", lambda: identified_lines(read_lines(spark, instances)))
    raw = parse_counted_instances(lines).where(F.col("value").isNotNull())
    named = lambda x: with_category_id(x, cats, "label").drop("label").withColumnRenamed("category_id", "label")
    inst, docs = keep("instances", lambda: named(raw)), keep("documents", lambda: named(instance_documents(lines)))
    vocab = keep("vocabulary", lambda: vocabulary(inst, MIN_COUNT), least=MIN_COUNT)
    write_dictionary(vocab, f"{out}/feat_id_map", ("feature", "fid"), "fid")
    grouped = keep("document-entries", lambda: count_vectors(inst, vocab, grouped=True), least=MIN_COUNT)
    entries = grouped_entries(grouped)
    pairs = F.transform("items", lambda x: F.struct((x["fidx"] + 1).alias("i"), x["value"].alias("v")))
    write_lines(grouped_libsvm_lines(grouped.select("doc_id", pairs.alias("_e")), docs), f"{out}/url_inst_fm")
    if num_feats > 0:
        top = keep("selected", lambda: top_features(chi_square(entries, docs), num_feats), least=MIN_COUNT, top=num_feats)
        write_dictionary(top.select("fidx", "new_fidx"), f"{out}/feat_sel_id_map", ("fidx", "new_fidx"), "fidx",
                         single_file=True)
        write_table(reindex(entries, top), f"{out}/url_inst_sel")
        entries = spark.read.parquet(f"{out}/url_inst_sel")  # the learners pass over it several times
        n_feat = top.count()
    else:
        largest = grouped.agg(F.max(F.element_at("items", -1)["fidx"])).first()[0]
        n_feat = 0 if largest is None else int(largest) + 1
    part = split_column("doc_id", 0.3)
    tests, test_e = docs.where(part == "test"), entries.where(part == "test")
    train, train_e = (docs, entries) if fit_on_all else (docs.where(part == "train"), entries.where(part == "train"))
    results = {}
    for name in [m for m in model.split(",") if m]:
        path = f"{out}/{name}_model"
        if name == "nb":
            fitted = fit_naive_bayes(to_vectors(train_e, train, n_feat), smoothing)
            save_model(fitted, path)
            scored = fitted.transform(to_vectors(test_e, tests, n_feat)).select("n_entries", "label", "prediction")
        elif name == "nb_table":
            Bayes(*nb_tables(train_e, train, n_feat, smoothing)).save(path)
            scored = predict_bayes(load_bayes(spark, path), test_e, tests)
        elif name == "rf":
            grow_forest(train_e, train, n_feat, num_trees, DEFAULT_DEPTH, DEFAULT_BINS, seed).save(path)
            sized = test_e.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_entries"))
            found = predict_forest(load_forest(spark, path), test_e, tests, num_trees, DEFAULT_DEPTH)
            scored = found.join(sized, "doc_id", "left").withColumn("n_entries", F.coalesce("n_entries", F.lit(0)))
        else:
            continue
        results[name] = TrainResult(n_feat, holdout_metrics(scored).first().asDict())
    return results
