"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from the bytes of the whole text (class shares, word and line
repetition). Trees are fitted on a bounded, hash-chosen sample of labelled rows and
flattened into arrays; a batch of rows walks all trees at once in numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000  # labelled rows that the trees are fitted on, at most
TREES, DEPTH, BINS = 80, 4, 64
RATE, SMOOTHING, LEAST_ROWS = 0.2, 1.0, 10
THRESHOLD = 0.3
HELD_OUT_MOD = 5

_CLASS_NAMES = ("lower", "upper", "digit", "blank", "newline", "high", "stop", "comma", "bang", "pipe", "symbol", "control")


def _byte_classes() -> np.ndarray:
    of = {name: i for i, name in enumerate(_CLASS_NAMES)}
    table = np.full(256, of["symbol"], np.intp)
    table[:32] = of["control"]
    table[127] = of["control"]
    table[128:] = of["high"]
    for chars, name in ((b"abcdefghijklmnopqrstuvwxyz", "lower"), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "upper"),
                        (b"0123456789", "digit"), (b" \t", "blank"), (b"\n\r", "newline"), (b".?", "stop"),
                        (b",;:'\"()-", "comma"), (b"!", "bang"), (b"|", "pipe")):
        table[list(chars)] = of[name]
    return table


_CLASSES = _byte_classes()
FEATURES = (*_CLASS_NAMES, "log_bytes", "log_words", "word_bytes", "long_words", "distinct_words", "repeated_next",
            "top_word", "upper_words", "log_lines", "line_bytes", "repeated_lines", "closed_lines", "worst_part")


def statistics(text: str | None) -> list[float]:
    """The feature vector of one whole text; null and empty texts are all zeros."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(data, np.uint8)
    counts = np.zeros(256, np.int64)
    worst = 0.0
    for at in range(0, len(raw), 4096):  # the part with the largest share of odd bytes, too
        part = np.bincount(raw[at: at + 4096], minlength=256)
        counts += part
        odd = part[33:127].sum() - part[48:58].sum() - part[97:123].sum() - part[[44, 46]].sum()
        worst = max(worst, odd / max(256, min(4096, len(raw) - at)))
    shares = np.bincount(_CLASSES, weights=counts, minlength=len(_CLASS_NAMES)) / len(data)
    words = data.split()
    n = max(1, len(words))
    lengths = list(map(len, words))
    often = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    return [*shares.tolist(), float(np.log1p(len(data))), float(np.log1p(len(words))), sum(lengths) / n,
            sum(x > 20 for x in lengths) / n, len(often) / n, sum(map(eq, words, words[1:])) / n,
            max(often.values(), default=0) / n, sum(map(bytes.isupper, words)) / n, float(np.log1p(len(lines))),
            min(1e6, sum(map(len, lines)) / m), 1 - len(set(lines)) / m,
            sum(x.rstrip().endswith((b".", b"?", b"!", b'"')) for x in lines) / m, float(worst)]


@dataclass
class Model:
    """Complete binary trees in arrays: node k of tree t splits feature[t, k] at
    threshold[t, k] into nodes 2k + 1 (at most) and 2k + 2; leaf[t, j] are the values."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, all trees stepping down together."""
        trees, inner = self.feature.shape
        margin = np.full(len(x), self.base)
        if trees:
            at = np.zeros((len(x), trees), np.intp)
            rows, cols = np.arange(len(x))[:, None], np.arange(trees)[None, :]
            for _ in range(int(np.log2(inner + 1))):
                right = x[rows, self.feature[cols, at]] > self.threshold[cols, at]
                at = 2 * at + 1 + right
            margin += self.leaf[cols, at - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Model:
    """Boost ``trees`` trees of fixed ``depth`` on the log loss with binned features."""
    inner = 2 ** depth - 1
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Model(base, np.zeros((0, inner), np.intp), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    features = np.zeros((trees, inner), np.intp)
    thresholds = np.full((trees, inner), np.inf)
    leaves = np.zeros((trees, inner + 1))
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.intp)
        for level in range(depth):
            width, first = 2 ** level, 2 ** level - 1
            best = np.full(width, 1e-6)
            for f, b in enumerate(binned):
                cell = (node - first) * bins + b
                sums = [np.cumsum(np.bincount(cell, w, width * bins).reshape(width, bins), axis=1)
                        for w in (g, h, np.ones(len(y)))]
                (gl, gt), (hl, ht), (nl, nt) = [(s[:, :-1], s[:, -1:]) for s in sums]
                gain = gl ** 2 / (hl + SMOOTHING) + (gt - gl) ** 2 / (ht - hl + SMOOTHING) - gt ** 2 / (ht + SMOOTHING)
                gain[(nl < LEAST_ROWS) | (nt - nl < LEAST_ROWS)] = 0
                cut = gain.argmax(axis=1)
                top = gain[np.arange(width), cut]
                for k in np.flatnonzero(top > best):
                    best[k] = top[k]
                    features[t, first + k], thresholds[t, first + k] = f, edges[f][cut[k]]
            goes = x[np.arange(len(y)), features[t, node]] > thresholds[t, node]
            node = 2 * node + 1 + goes
        node -= inner
        value = RATE * np.bincount(node, g, inner + 1) / (np.bincount(node, h, inner + 1) + SMOOTHING)
        leaves[t] = value
        margin += value[node]
    return Model(base, features, thresholds, leaves)


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text is divisible by 5 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HELD_OUT_MOD == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled, not held-out documents, the ones with the
    smallest id hashes; of rows that repeat an id, the one with the smallest text hash.
    Repeated labels of a document are averaged; null labels and ids are left out. Without
    both classes the model answers the share of label 1 (0.5)."""
    kept = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    marks = kept.groupBy(id_col).agg((F.avg(F.col(label_col).cast("double")) >= 0.5).cast("double").alias("_y"))
    sample = marks.orderBy(F.xxhash64(id_col), id_col).limit(sample_rows)
    # at most sample_rows rows of two numbers: a proven bound for the broadcast
    rows = docs.select(id_col, F.col(text_col).cast("string").alias("_text")).join(F.broadcast(sample), id_col)

    @F.pandas_udf("array<double>")
    def describe(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    described = rows.select(id_col, "_y", F.struct(F.xxhash64("_text"), describe("_text").alias("x")).alias("_s"))
    one = described.groupBy(id_col).agg(F.first("_y").alias("_y"), F.min("_s").alias("_s"))
    got = one.select("_y", F.col("_s.x").alias("_x")).toPandas()  # at most sample_rows rows
    x = np.array(got["_x"].tolist(), float).reshape(len(got), len(FEATURES))
    order = np.lexsort([*x.T, got["_y"].to_numpy(float)])  # the same trees whatever order the rows came in
    return fit(x[order], got["_y"].to_numpy(float)[order])


def scorer(model: Model) -> Callable[..., Column]:
    """A column function text -> probability of label 1."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts], float).reshape(len(texts), len(FEATURES))
        return pd.Series(model.probability(x))

    return score


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 where score >= threshold).

    Every row is scored, null and empty texts as all-zero statistics, repeated rows
    alike; an empty table gives no rows. Existing columns named score or predicted are
    replaced, other columns kept.
    """
    score = scorer(train(docs, labels, id_col, text_col, label_col))
    out = docs.withColumn("score", score(F.col(text_col).cast("string")))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
