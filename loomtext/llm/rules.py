"""Quality rules: boosted trees over document statistics, monotone where a rule says so.

Each whole text gives exact base counts (words, symbols, repeated lines, words in repeated
five-word windows) and shares made from them. A tree may only lower its answer as a share
of ``FALLING`` grows: splits that would raise it are not taken, and the bounds that a split
sets hold for everything below it. All trees lie in one set of flat node arrays, which a
batch of rows walks together.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 5  # words
LEAST_WORDS, MOST_REPEATED = 10, 20  # fewer words, or a larger percentage of repeated ones, fail
SYMBOLS = b"#*$%&|<>"
SAMPLE_ROWS = 20_000  # labelled rows that the trees are fitted on, at most
TREES, LEAVES, BINS = 60, 12, 64
RATE, SMOOTHING, LEAST_ROWS = 0.2, 1.0, 20
KEEP = 0.3  # least probability of label 1 that keeps a document
HELD_OUT_MOD = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FALLING = ("symbol_share", "dup_lines", "repeat_words", "top_word", "long_words", "controls", "worst_part", "same_next")
FEATURES = (*FALLING, "log_words", "word_chars", "distinct_words", "digits", "capitals", "non_ascii", "stops", "commas",
            "closed_lines", "log_lines", "line_words")
SIGNS = np.array([-1 if name in FALLING else 0 for name in FEATURES])


def _codes(items: list[bytes]) -> np.ndarray:
    """A number per item, equal for equal items."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(x, len(seen)) for x in items), np.int64, len(items))


def repeated_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a run of ``window`` words found twice or more, the first included."""
    n = len(codes) - window + 1
    if n < 2:
        return 0
    key = codes[:n]
    for k in range(1, window):  # ranks of ever longer windows, so the pair fits 64 bits
        key = np.unique(key * (len(codes) + 1) + codes[k: n + k], return_inverse=True)[1]
    often = np.bincount(key)[key] > 1
    edge = np.zeros(len(codes) + 1, np.int64)
    edge[:n] += often
    edge[window: n + window] -= often
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def measure(text: str | None) -> tuple[tuple[int, ...], list[float]]:
    """``COUNTS`` and ``FEATURES`` of one whole text; null and empty texts are all zeros."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # at the six blanks 0x20 and 0x09 to 0x0D, as the word pattern does
    if not words:
        return (0, 0, _symbols(data), 0, 0), [0.0] * len(FEATURES)
    raw = np.frombuffer(data, np.uint8)
    of = np.bincount(raw, minlength=256)
    points = len(data) - int(of[128:192].sum())  # bytes that do not continue a character
    word_chars = points - int(of[9:14].sum() + of[32])
    n, symbols = len(words), int(of[list(SYMBOLS)].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    codes = _codes(words)
    dup, again = len(lines) - len(set(lines)), repeated_words(codes)
    often = np.bincount(codes)
    size = len(data)
    worst = max((sum(part.count(s) for s in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">", b"{", b"}", b"=", b"/"))
                 / max(256, len(part)) for part in (data[i: i + 4096] for i in range(0, size, 4096))))
    ends = sum(x.rstrip().endswith((b".", b"?", b"!", b'"', b":")) for x in lines)
    features = [symbols / word_chars, dup / len(lines), again / n, float(often.max()) / n, sum(len(w) > 20 for w in words) / n,
                float(of[:9].sum() + of[14:32].sum() + of[127]) / size, worst, float(np.count_nonzero(codes[1:] == codes[:-1])) / n,
                float(np.log1p(n)), word_chars / n, len(often) / n, float(of[48:58].sum()) / size, float(of[65:91].sum()) / size,
                float(of[128:].sum()) / size, float(of[[33, 46, 63]].sum()) / size, float(of[[44, 58, 59]].sum()) / size,
                ends / len(lines), float(np.log1p(len(lines))), n / len(lines)]
    return (n, word_chars, symbols, dup, again), features


def _symbols(data: bytes) -> int:
    return sum(map(data.count, (bytes([c]) for c in SYMBOLS)))


@dataclass
class Forest:
    """All nodes of all trees in flat arrays: node k asks feature[k] <= threshold[k] and
    goes to left[k] or right[k]; a leaf has feature -1 and leads to itself."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        if len(self.roots) and len(x):
            at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
            rows = np.arange(len(x))[:, None]
            while (inner := self.feature[at] >= 0).any():
                high = x[rows, np.maximum(self.feature[at], 0)] > self.threshold[at]
                at = np.where(inner, np.where(high, self.right[at], self.left[at]), at)
            margin += self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _best_split(rows, binned, g, h, signs, low, high):
    """(gain, feature, bin, left value, right value) of the best allowed split, or None."""
    best, gs, hs = None, g[rows].sum(), h[rows].sum()
    at_all = np.clip(gs / (hs + SMOOTHING), low, high)
    stay = at_all * gs - at_all ** 2 * (hs + SMOOTHING) / 2
    for f, column in enumerate(binned):
        b = column[rows]
        gl, hl, nl = [np.cumsum(np.bincount(b, w, BINS))[:-1] for w in (g[rows], h[rows], None)]
        gr, hr, nr = gs - gl, hs - hl, len(rows) - nl
        vl, vr = np.clip(gl / (hl + SMOOTHING), low, high), np.clip(gr / (hr + SMOOTHING), low, high)
        gain = vl * gl - vl ** 2 * (hl + SMOOTHING) / 2 + vr * gr - vr ** 2 * (hr + SMOOTHING) / 2 - stay
        gain[(nl < LEAST_ROWS) | (nr < LEAST_ROWS) | (signs[f] * (vr - vl) < 0)] = 0
        k = int(gain.argmax())
        if gain[k] > (best[0] if best else 1e-6):
            best = (float(gain[k]), f, k, float(vl[k]), float(vr[k]))
    return best


def fit(x: np.ndarray, y: np.ndarray, signs: np.ndarray = SIGNS, trees: int = TREES, leaves: int = LEAVES) -> Forest:
    """Boost on the log loss, the split of the largest gain first. Under a split on a
    feature with a sign, the middle of both answers bounds what either side may answer."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    cells: list[list] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if len(y) and y.min() != y.max():
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = [np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)]
        margin = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            root = len(cells)
            roots.append(root)
            cells.append([-1, 0.0, root, root, float(g.sum() / (h.sum() + SMOOTHING))])
            held = {root: (np.arange(len(y)), -np.inf, np.inf)}
            heap: list = []

            def offer(k):
                rows, low, high = held[k]
                split = _best_split(rows, binned, g, h, signs, low, high)
                if split:
                    heapq.heappush(heap, (-split[0], k, split[1:]))

            offer(root)
            while heap and len(held) < leaves:
                _, k, (f, cut, vl, vr) = heapq.heappop(heap)
                rows, low, high = held.pop(k)
                goes, middle = binned[f][rows] > cut, (vl + vr) / 2
                sides = ((rows[~goes], vl, low if signs[f] >= 0 else middle, high if signs[f] <= 0 else middle),
                         (rows[goes], vr, low if signs[f] <= 0 else middle, high if signs[f] >= 0 else middle))
                first = len(cells)
                cells[k][:4] = [f, float(edges[f][cut]), first, first + 1]
                for side, (own, value, lo, hi) in enumerate(sides):
                    cells.append([-1, 0.0, first + side, first + side, value])
                    held[first + side] = (own, lo, hi)
                for side in (0, 1):
                    offer(first + side)
            for k, (rows, _, _) in held.items():
                cells[k][4] *= RATE
                margin[rows] += cells[k][4]
    f, t, a, b, v = [np.array(c) for c in zip(*cells, strict=True)] if cells else [np.zeros(0)] * 5
    return Forest(base, np.array(roots, np.intp), f.astype(np.intp), t.astype(float), a.astype(np.intp), b.astype(np.intp),
                  v.astype(float))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Fit on the ``sample_rows`` labelled documents with the smallest id hashes, of those
    whose id's CRC-32 is not divisible by 5. Labels of a repeated id are averaged, and of
    its texts the one with the smallest hash counts; null ids and labels are left out.
    Without both labels the model answers their share (0.5 without any)."""
    labels = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("label"))
    held = F.crc32(F.col("id").cast("string")) % HELD_OUT_MOD == 0
    marks = labels.where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held) \
        .groupBy("id").agg((F.avg("label") >= 0.5).cast("double").alias("y"))
    sample = marks.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # at most sample_rows rows of two numbers: a proven bound for the broadcast
    found = texts.join(F.broadcast(sample), "id").select("id", "y", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [measure(t)[1] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(3), pa.array(x, pa.list_(pa.float64()))],
                                             names=["id", "y", "hash", "x"])

    kind = found.schema["id"].dataType.simpleString()
    stats = found.withColumn("hash", F.xxhash64("text")).mapInArrow(run, f"id {kind}, y double, hash long, x array<double>")
    one = stats.groupBy("id").agg(F.min(F.struct("hash", "x")).alias("s"), F.first("y").alias("y"))
    got = one.select("id", "y", "s.x").toPandas()  # at most sample_rows rows
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    order = np.lexsort([*x.T, got["y"].to_numpy(float)])
    return fit(x[order], got["y"].to_numpy(float)[order])


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", keep: float = KEEP) -> DataFrame:
    """One row per input row: id, ``COUNTS``, base_failed, score (probability of label 1),
    kept (false if base_failed, else score >= ``keep``).

    Null and empty texts have no words and fail; texts of any length are measured whole;
    repeated rows and equal ids are rows of their own with equal results; a null id is
    kept as it is; an empty table gives no rows; other columns are not read.
    """
    forest = train(docs, labels, id_col, text_col, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t) for t in batch.column(1).to_pylist()]
            counts = np.array([c for c, _ in found], np.int64).reshape(len(found), len(COUNTS))
            score = forest.probability(np.array([f for _, f in found], float).reshape(len(found), len(FEATURES)))
            n, again = counts[:, 0], counts[:, 4]
            failed = (n < LEAST_WORDS) | (100 * again > MOST_REPEATED * n)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts.T), pa.array(failed), pa.array(score),
                                              pa.array(~failed & (score >= keep))], names=names)

    names = [id_col, *COUNTS, "base_failed", "score", "kept"]
    kind = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, {counts}, base_failed boolean, score double, kept boolean")
