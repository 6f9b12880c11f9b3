"""Token documents to sparse vectors in long form.

A document row keeps its whole token array; per-document work (distinct tokens, term
counts, token total) is done inside the row with array functions, so no shuffle is
needed before the vocabulary join. The vocabulary is joined by equality on the token
(broadcast when its checked size allows; else its most frequent tokens are broadcast and
the rest is shuffled), and entries come out as ``(doc_id, label, fid, value)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.functions.arrays import explode_rows
from loomtext.operators.sizing import BROADCAST_BYTES, fits
from loomtext.session import reliable_checkpoint

HEAVY_TOKENS = 20_000  # most frequent tokens that every task holds of a larger vocabulary
HEAVY_BYTES = 64  # of a token among them, at most: rows x bytes bound the broadcast


def with_term_counts(df: DataFrame, tokens: str, out: str = "term_counts") -> DataFrame:
    """Add ``out`` = ``array<struct<token, tf>>``: each distinct token of ``tokens``
    with its number of occurrences, from runs of a sorted copy (no shuffle).

    Lambda bodies re-evaluate any expression they capture for every element, so the
    sorted array and the run starts are separate columns the lambdas refer to.
    """
    keep = [c for c in df.columns if c != out]
    s = df.select(*keep, F.sort_array(F.col(tokens)).alias("_s"))
    n = F.size(F.col("_s"))
    s = s.select(*keep, "_s", F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i == 1) | (F.element_at(F.col("_s"), i) != F.element_at(F.col("_s"), i - 1))).alias("_st"))
    m = F.size(F.col("_st"))
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(m, F.lit(1))),
        lambda j: F.struct(
            F.element_at(F.col("_s"), F.element_at(F.col("_st"), j)).alias("token"),
            (F.when(j == m, n + 1).otherwise(F.element_at(F.col("_st"), j + 1)) - F.element_at(F.col("_st"), j))
            .cast("long").alias("tf")))
    empty = F.array().cast("array<struct<token:string,tf:bigint>>")
    return s.select(*keep, F.when(n > 0, runs).otherwise(empty).alias(out))


def frequent_tokens(vocab: DataFrame, heavy: int = HEAVY_TOKENS) -> DataFrame:
    """The ``heavy`` most frequent tokens of a vocabulary (by its counts; without counts by
    its ids, which count down from the most frequent feature)."""
    order = F.col("cnt").desc() if "cnt" in vocab.columns else F.col("fid").asc()
    return vocab.where(F.octet_length("token") <= HEAVY_BYTES).orderBy(order, "token").limit(heavy)


def join_vocabulary(rows: DataFrame, vocab: DataFrame, limit: int = BROADCAST_BYTES, heavy: int = HEAVY_TOKENS) -> DataFrame:
    """``rows`` (token, ...) with the other columns of ``vocab`` (token, fid, ...), rows
    without a match gone.

    A vocabulary within ``limit`` bytes is broadcast. Of a larger one the most frequent
    tokens are, so a token that is in every document never moves; only rows of rarer
    tokens, no key of which is large, are shuffled to the rest."""
    if fits(vocab, limit):
        return rows.join(F.broadcast(vocab), "token")
    top = reliable_checkpoint(frequent_tokens(vocab, heavy), "frequent-tokens")
    names = F.broadcast(top.select("token"))
    rare = rows.join(names, "token", "left_anti").join(vocab.join(names, "token", "left_anti").hint("merge"), "token")
    return rows.join(F.broadcast(top), "token").unionByName(rare)


def _named(vocab: DataFrame) -> DataFrame:
    counts = ["cnt"] if "cnt" in vocab.columns else []
    return vocab.select(F.col("feature").alias("token"), "fid", *counts)


def distinct_tokens(docs: DataFrame, tokens: str = "tokens", keep=("doc_id", "label")) -> DataFrame:
    """``(keep..., token)`` with each token of a document once."""
    return explode_rows(docs, F.array_distinct(F.col(tokens)), "token", keep)


def binary_vectors(docs: DataFrame, vocab: DataFrame, tokens: str = "tokens",
                   limit: int = BROADCAST_BYTES) -> DataFrame:
    """M1 (+A13, J3, F4): ``(doc_id, label, fid, value=1)`` per distinct in-vocabulary
    token; a document with none has no rows."""
    dt = distinct_tokens(docs, tokens)
    return join_vocabulary(dt, _named(vocab), limit).select(
        "doc_id", "label", "fid", F.lit(1).cast("int").alias("value"))


def count_vectors(instances: DataFrame, vocab: DataFrame, limit: int = BROADCAST_BYTES,
                  one_row_per_feature: bool = False, grouped: bool = False) -> DataFrame:
    """M3: ``(doc_id, label, fid, value)`` from counted instances
    ``(doc_id, label, feature, value)``; a feature repeated in one instance is summed.

    ``one_row_per_feature=True`` states that the input already has one row per
    (document, feature), as :func:`counted_instances` gives, and skips that shuffle.
    ``grouped=True`` gives one row ``(doc_id, label, items)`` per document with entries, items
    being its (fidx, value) in ascending order, ``fidx = fid - 1``; one exchange on the
    document serves the sums and the grouping.
    """
    rows = instances.select("doc_id", "label", F.col("feature").alias("token"), "value")
    e = join_vocabulary(rows, _named(vocab), limit)
    if one_row_per_feature and not grouped:
        return e.select("doc_id", "label", "fid", F.col("value").cast("long").alias("value"))
    if grouped:
        e = e.select("doc_id", "label", "fid", "value").repartition("doc_id")
    summed = e.groupBy("doc_id", "label", "fid").agg(F.sum("value").cast("long").alias("value"))
    if not grouped:
        return summed
    item = F.struct((F.col("fid") - 1).alias("fidx"), "value")
    return summed.groupBy("doc_id", "label").agg(F.sort_array(F.collect_list(item)).alias("items"))


def grouped_entries(grouped: DataFrame) -> DataFrame:
    """``(doc_id, label, fidx, value)`` of grouped :func:`count_vectors`; a filter on documents
    comes before the explode, so it is asked once a document."""
    return explode_rows(grouped, F.col("items"), "item", ("doc_id", "label")).select("doc_id", "label", "item.fidx", "item.value")


def counted_instances(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Documents as counted instances ``(doc_id, label, feature, value, n_tokens)``:
    one row per distinct token of a document with its count; ``n_tokens`` is the
    document's total token count (all tokens, repeats included)."""
    sized = docs.select("doc_id", "label", tokens, F.size(F.col(tokens)).alias("n_tokens"))
    tc = with_term_counts(sized, tokens, "_tc")
    return explode_rows(tc, F.col("_tc"), "tc", ("doc_id", "label", "n_tokens")).select(
        "doc_id", "label", F.col("tc.token").alias("feature"), F.col("tc.tf").alias("value"), "n_tokens")


def tfidf_vectors(docs: DataFrame, vocab: DataFrame, idf: DataFrame, tokens: str = "tokens",
                  limit: int = BROADCAST_BYTES) -> DataFrame:
    """M2 + J4: value = ``1/T * idf(fid - 1)``, T = all tokens of the document
    (repeats and out-of-vocabulary ones included); a repeated token counts once.

    The weights join the vocabulary, one row a feature on both sides, and travel with it:
    entries meet both in one join. A vocabulary id without an idf row fails the query, as
    a missing model key must.
    """
    sized = docs.select("doc_id", "label", F.size(F.col(tokens)).alias("_t"), F.col(tokens))
    dt = explode_rows(sized, F.array_distinct(F.col(tokens)), "token", ("doc_id", "label", "_t"))
    weights = idf.select((F.col("fidx") + 1).alias("fid"), "idf")
    side = reliable_checkpoint(_named(vocab).join(weights, "fid", "left"), "weighted-vocabulary")
    e = join_vocabulary(dt, side, limit)
    val = (F.lit(1.0) / F.col("_t")) * F.col("idf")
    checked = F.when(F.col("idf").isNotNull(), val).otherwise(
        F.raise_error(F.concat(F.lit("no idf for feature id "), F.col("fid").cast("string"))))
    return e.select("doc_id", "label", "fid", checked.cast("double").alias("value"))
