"""Chi-square feature selection on long-form vectors.

Pearson's statistic for feature f over N documents, with the feature value (zero
included) as one variable and the label as the other::

    chi2 = N * (sum over cells O^2 / (n_v * n_l) - 1)

Only non-zero cells are stored. The zero-value cell of label l is ``n_l - S_fl``
(``S_fl`` = documents of label l with a non-zero value), and summed over labels it
reduces to ``(2 n_0 - N + sum_l S_fl^2 / n_l) / n_0`` with ``n_0`` documents at zero.
So every term comes from observed (feature, value, label) groups: no features x labels
grid is ever built. With O, n_v and S_fl beside each group, a group adds ``O^2 / (n_v n_l)``
to the first sum and ``O S_fl / n_l`` to the second (the groups of a label add up to
``S_fl^2 / n_l``), so one exchange of the groups by feature serves both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtext.operators.ids import dense_ids
from loomtext.operators.sizing import broadcast_if_small

DEFAULT_TOP_K = 100
# Statistics are compared at this many decimals when ranking, so values equal up to
# floating noise tie and fall back to the smaller feature index.
RANK_DECIMALS = 6


def chi_square(entries: DataFrame, docs: DataFrame) -> DataFrame:
    """``(fidx, chi2)`` for every feature with a stored non-zero value.

    ``entries``: ``(doc_id, label, fidx, value)``; ``docs``: ``(doc_id, label)`` with
    every document, including those without entries.
    """
    obs = (entries.where(F.col("value") != 0)
           .groupBy("fidx", "value", "label").agg(F.count(F.lit(1)).alias("o")))
    return chi_square_of_groups(obs, docs.groupBy("label").agg(F.count(F.lit(1)).alias("n_l")))


def chi_square_of_groups(obs: DataFrame, labels: DataFrame) -> DataFrame:
    """A7 of ``(fidx, value, label, o)``, the documents o of each group with a non-zero value,
    and ``(label, n_l)``, all documents of each label."""
    n_total = labels.agg(F.sum("n_l").cast("double")).scalar()
    n_l = broadcast_if_small(labels)
    obs = obs.join(n_l, "label").repartition("fidx")  # serves both windows and the sums per feature
    obs = obs.withColumn("n_v", F.sum("o").over(Window.partitionBy("fidx", "value"))) \
        .withColumn("s_fl", F.sum("o").over(Window.partitionBy("fidx", "label")))
    sums = obs.groupBy("fidx").agg(
        F.sum(F.col("o") * F.col("o") / (F.col("n_v") * F.col("n_l"))).alias("t1"),
        F.sum(F.col("o") * F.col("s_fl") / F.col("n_l")).alias("q"), F.sum("o").alias("s_f"))
    n0 = F.lit(n_total) - F.col("s_f")
    z = F.when(n0 > 0, (2 * n0 - F.lit(n_total) + F.col("q")) / n0).otherwise(F.lit(0.0))
    return sums.select("fidx", (F.lit(n_total) * (F.col("t1") + z - 1.0)).alias("chi2"))


def top_features(chi: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """The k largest statistics (ties: smaller ``fidx``), renumbered
    ``new_fidx = 0..k-1`` in ascending ``fidx`` order. ``k <= 0`` keeps every feature.

    ``limit(k)`` after the sort plans as a top-k (``TakeOrderedAndProject``), so only
    k rows reach the final numbering.
    """
    if k <= 0:
        return dense_ids(chi, [F.col("fidx").asc()], id_col="new_fidx", start=0).select("fidx", "new_fidx", "chi2")
    ranked = chi.withColumn("_r", F.round("chi2", RANK_DECIMALS))
    picked = ranked.orderBy(F.col("_r").desc(), F.col("fidx").asc()).limit(k)
    w = Window.orderBy("fidx")  # k rows at most
    return picked.select("fidx", (F.row_number().over(w) - 1).cast("long").alias("new_fidx"), "chi2")


def reindex(entries: DataFrame, selected: DataFrame, max_broadcast: int = 5_000_000) -> DataFrame:
    """Keep selected features only and renumber them: ``fidx`` becomes the new id."""
    sel = broadcast_if_small(selected.select("fidx", "new_fidx"), max_broadcast)
    return entries.join(sel, "fidx").select("doc_id", "label", F.col("new_fidx").alias("fidx"), "value")
