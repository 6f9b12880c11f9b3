"""Holdout metrics.

With t test documents, c of them classified (non-empty vector) and e wrong:
``test_err = e/c``, ``test_acc = (c-e)/c``, ``test_rec = (c-e)/t`` and ``f1`` the
harmonic mean of accuracy and recall. A zero denominator gives null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def holdout_metrics(scored: DataFrame) -> DataFrame:
    """A8 in one aggregation pass over ``(n_entries, label, prediction)`` rows of every
    test document; rows with ``n_entries = 0`` count in the total only (F7)."""
    classified = F.col("n_entries") > 0
    agg = scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(classified).alias("classified"),
        F.count_if(classified & (F.col("prediction") != F.col("label"))).alias("errors"))
    c, e, t = F.col("classified"), F.col("errors"), F.col("total")
    acc = F.try_divide((c - e).cast("double"), c)
    rec = F.try_divide((c - e).cast("double"), t)
    f1 = F.try_divide(F.lit(2.0), F.try_divide(F.lit(1.0), acc) + F.try_divide(F.lit(1.0), rec))
    return agg.select("total", "classified", "errors",
                      F.try_divide(e.cast("double"), c).alias("test_err"),
                      acc.alias("test_acc"), rec.alias("test_rec"), f1.alias("f1"))
