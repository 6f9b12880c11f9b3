"""Alignment of two tokenizations of the same text, and corpus-wide pair counts.

Both tokenizers give the bytes of a blank and the text. Byte offsets where a token of A and
one of B both end cut the tokens into groups; inside a group, tokens whose bytes overlap
are linked. A range of a text's bytes gives a *fragment*: the tokens up to its first common
end (open prefix), the groups it closes, and the tokens after its last common end (open
suffix). Fragments compose associatively, the open ends that meet closing one group, so
ranges of a very long text are tokenized in different tasks and reduced as a tree.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import store

FOLDER = "/opt/tokenizers"  # the same for every executor is not needed: the driver reads and broadcasts the files
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
RANGE_BYTES = 1 << 16  # of a long text's ranges
SLICE_BYTES = 1 << 18  # of short texts aligned at once
FAN_IN = 16  # fragments that one step of the tree reduction composes
HOT_PAIRS = 1 << 19  # most frequent pairs that every task holds; the rest are joined by shuffle
# Fixed value: how the byte-level vocabulary cuts a text into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SAFE = regex.compile(r"(?<=\S) (?=\S)")  # a lone blank: both tokenizers start anew at it


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary entry stands for: printable
    ones stand for themselves, the others are numbered from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both vocabularies, from the contents of their files."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes) -> None:
        import sentencepiece
        import tiktoken

        vocab = json.loads(byte_bpe)
        of = _byte_of()
        added = {x["content"] for x in vocab["added_tokens"] if x["special"]}
        ranks = {bytes(of[c] for c in s): i for s, i in vocab["model"]["vocab"].items() if s not in added}
        self.a = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        self.entry_a = [b""] * (max(ranks.values()) + 1)
        for s, i in ranks.items():
            self.entry_a[i] = s
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.entry_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.long_a, self.long_b = [np.array([len(x) for x in e], np.int64) for e in (self.entry_a, self.entry_b)]
        # texts of a token inside a group: more of its side follow, or it is the last of it
        self.shown = [b"%d%c" % (i, c) for i in range(len(self.entry_a)) for c in b",|"] \
            + [b"%d%c" % (i, c) for i in range(len(pieces)) for c in b",;"]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of a blank and each text by A, and of the text by B, which adds the blank;
        None where the tokens' bytes are not just those."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            a, data = self.a.encode_ordinary(" " + text), b" " + text.encode()
            same = b"".join(map(self.entry_a.__getitem__, a)) == data == b"".join(map(self.entry_b.__getitem__, b))
            out.append((a, b) if same else None)
        return out


@lru_cache(maxsize=2)
def _built(byte_bpe: bytes, piece_bpe: bytes) -> Tokenizers:
    return Tokenizers(byte_bpe, piece_bpe)


def _empty() -> np.ndarray:
    return np.empty(0, np.int64)


@dataclass
class Fragment:
    """What a range of bytes gives. A run of tokens is (A ids, A ends, B ids, B ends), the
    ends counted from the start of the text. Without any common end (``cut`` false) all
    tokens stand in ``prefix``. ``pairs`` (sorted) and ``times`` count the closed links."""

    ok: bool = True
    n_a: int = 0
    n_b: int = 0
    cut: bool = False
    prefix: tuple = field(default_factory=lambda: (_empty(),) * 4)
    n_groups: int = 0
    n_links: int = 0
    pairs: np.ndarray = field(default_factory=_empty)
    times: np.ndarray = field(default_factory=_empty)
    groups: bytes = b""
    suffix: tuple = field(default_factory=lambda: (_empty(),) * 4)


def _linked(a, ends_a, b, ends_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, place in A, place in B) of every overlap of two cuts of the same bytes: each
    stretch between neighbouring ends of either side lies in one token of both."""
    ends = np.union1d(ends_a, ends_b)
    return ends, np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def _written(a, ends_a, b, ends_b, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``shown``, number of tokens up to each common end) of whole groups."""
    spot = np.searchsorted(ends_b, ends_a)
    last_a = ends_b[np.minimum(spot, len(ends_b) - 1)] == ends_a
    last_b = np.zeros(len(b), bool)
    last_b[spot[last_a]] = True
    through_a, through_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # group of each token
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + np.concatenate([[0], through_b])[of_a]] = 2 * a + last_a
    out[np.arange(len(b)) + through_a[of_b]] = 2 * (width + b) + last_b
    return out, through_a + through_b


def closed(run: tuple, tools: Tokenizers) -> Fragment:
    """The groups of a run whose last end is a common one, as a fragment without open ends."""
    a, ends_a, b, ends_b = run
    if not len(a):
        return Fragment()
    _, at_a, at_b = _linked(*run)
    pairs, times = np.unique(a[at_a] * len(tools.entry_b) + b[at_b], return_counts=True)
    shown, through = _written(*run, len(tools.entry_a))
    return Fragment(cut=True, n_groups=len(through), n_links=len(at_a), pairs=pairs, times=times,
                    groups=b"".join(map(tools.shown.__getitem__, shown.tolist())))


def fragment(run: tuple, tools: Tokenizers) -> Fragment:
    """The fragment of the tokens that end in one range."""
    a, ends_a, b, ends_b = run
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if not len(common):
        return Fragment(n_a=len(a), n_b=len(b), prefix=run)
    (a0, b0), (a1, b1) = [(np.searchsorted(ends_a, e, "right"), np.searchsorted(ends_b, e, "right")) for e in (common[0], common[-1])]
    out = closed((a[a0:a1], ends_a[a0:a1], b[b0:b1], ends_b[b0:b1]), tools)
    out.n_a, out.n_b, out.cut = len(a), len(b), True
    out.prefix = (a[:a0], ends_a[:a0], b[:b0], ends_b[:b0])
    out.suffix = (a[a1:], ends_a[a1:], b[b1:], ends_b[b1:])
    return out


def _joined(x: tuple, y: tuple) -> tuple:
    return tuple(np.concatenate([p, q]) for p, q in zip(x, y, strict=True))


def compose(x: Fragment, y: Fragment, tools: Tokenizers) -> Fragment:
    """The fragment of two neighbouring ranges. Associative; an empty Fragment is neutral."""
    out = Fragment(x.ok and y.ok, x.n_a + y.n_a, x.n_b + y.n_b, x.cut or y.cut, x.prefix, suffix=y.suffix)
    if not x.cut:
        out.prefix = _joined(x.prefix, y.prefix)
    elif not y.cut:
        out.suffix = _joined(x.suffix, y.prefix)
    middle = closed(_joined(x.suffix, y.prefix), tools) if x.cut and y.cut else Fragment()
    parts = [x, middle, y]
    out.n_groups, out.n_links = sum(p.n_groups for p in parts), sum(p.n_links for p in parts)
    out.groups = b"".join(p.groups for p in parts)
    out.pairs, at = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
    out.times = np.bincount(at, np.concatenate([p.times for p in parts]), len(out.pairs)).astype(np.int64)
    return out


def finished(x: Fragment, tools: Tokenizers) -> Fragment:
    """A whole text's fragment: the start of a text is a common end before its prefix."""
    return compose(Fragment(cut=True), x, tools) if x.ok else Fragment(ok=False)


def ranges(text: str, size: int = RANGE_BYTES) -> list[tuple[int, int, int, str]]:
    """(low, high, start, context): byte ranges (low, high] of a blank and the text, about
    ``size`` long, with the text from the last safe blank up to low to the first one from
    high on, whose tokens are those of the whole text. Where no blank is safe for longer
    than a range, the range goes on to the next one, so a stretch is read at most twice."""
    whole = " " + text
    safe = [0, *(m.start() for m in _SAFE.finditer(whole)), len(whole)]
    step = np.cumsum([0, *(len(whole[a:b].encode()) for a, b in zip(safe, safe[1:]))])  # their byte offsets
    out, low = [], 0
    while low < step[-1]:
        high = min(low + size, int(step[-1]))
        after = int(np.searchsorted(step, high))
        if step[after] - step[max(0, after - 1)] > size:
            high = int(step[after])
        first = int(np.searchsorted(step, low, "right")) - 1
        out.append((low, high, int(step[first]), whole[safe[first]: safe[after]]))
        low = high
    return out


def _range_fragment(low: int, high: int, start: int, context: str, tools: Tokenizers) -> Fragment:
    ids = tools.encode([context[1:]])[0]  # a context starts with its blank
    if ids is None:
        return Fragment(ok=False)
    run = []
    for side, sizes in zip(ids, (tools.long_a, tools.long_b), strict=True):
        side = np.array(side, np.int64)
        ends = start + np.cumsum(sizes[side])
        inside = (ends > low) & (ends <= high)
        run += [side[inside], ends[inside]]
    return fragment(tuple(run), tools)


_RUN = ("a", "ends_a", "b", "ends_b")
_FRAGMENT = "ok boolean, n_a long, n_b long, cut boolean, n_groups long, n_links long, pairs array<long>, times array<long>, " \
    "groups binary, " + ", ".join(f"{k}_{c} array<long>" for k in ("prefix", "suffix") for c in _RUN)


def _row(x: Fragment) -> dict:
    return {"ok": x.ok, "n_a": x.n_a, "n_b": x.n_b, "cut": x.cut, "n_groups": x.n_groups, "n_links": x.n_links, "pairs": x.pairs,
            "times": x.times, "groups": x.groups} | {f"{k}_{c}": v for k in ("prefix", "suffix")
                                                     for c, v in zip(_RUN, getattr(x, k), strict=True)}


def _fragment_of(r) -> Fragment:
    runs = [tuple(np.asarray(getattr(r, f"{k}_{c}"), np.int64) for c in _RUN) for k in ("prefix", "suffix")]
    return Fragment(bool(r.ok), int(r.n_a), int(r.n_b), bool(r.cut), runs[0], int(r.n_groups), int(r.n_links),
                    np.asarray(r.pairs, np.int64), np.asarray(r.times, np.int64), bytes(r.groups), runs[1])


_RESULT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def _align_slice(texts: list[str], tools: Tokenizers) -> tuple:
    """Columns of ``_RESULT`` for short texts, aligned together: the texts' ends are common
    ends, so one pass over all their tokens keeps them apart."""
    ids = tools.encode(texts)
    rows = [k for k, x in enumerate(ids) if x is not None and texts[k]]
    a, b = [np.array([i for k in rows for i in ids[k][side]], np.int64) for side in (0, 1)]
    n_a, n_b, n_groups, n_links = [np.zeros(len(texts), np.int64) for _ in range(4)]
    sha, of = [""] * len(texts), np.array(rows, np.int64)
    if not rows:
        return n_a, n_b, n_groups, n_links, sha, np.zeros(len(texts) + 1, np.int32), _empty(), _empty()
    n_a[of], n_b[of] = [len(ids[k][0]) for k in rows], [len(ids[k][1]) for k in rows]
    ends_a, ends_b = np.cumsum(tools.long_a[a]), np.cumsum(tools.long_b[b])
    stops = ends_a[np.cumsum(n_a[of]) - 1]  # of the texts
    ends, at_a, at_b = _linked(a, ends_a, b, ends_b)
    text = np.searchsorted(stops, ends)
    n_links[of] = np.bincount(text, minlength=len(rows))
    width = len(tools.entry_a) * len(tools.entry_b)
    keys, times = np.unique(text * width + a[at_a] * len(tools.entry_b) + b[at_b], return_counts=True)
    shown, through = _written(a, ends_a, b, ends_b, len(tools.entry_a))
    pieces = list(map(tools.shown.__getitem__, shown.tolist()))
    until = np.cumsum(n_a[of] + n_b[of])
    n_groups[of] = np.diff(np.searchsorted(through, until, "right"), prepend=0)
    for k, low, high in zip(rows, [0, *until.tolist()], until.tolist(), strict=False):
        sha[k] = hashlib.sha256(b"".join(pieces[low:high])[:-1]).hexdigest()
    held = np.zeros(len(texts), np.int64)
    held[of] = np.bincount(keys // width, minlength=len(rows))
    return n_a, n_b, n_groups, n_links, sha, np.concatenate([[0], np.cumsum(held)]).astype(np.int32), keys % width, times


def _slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[list[str]]:
    held, size = [], 0
    for t in (x.as_py() for x in texts):
        if held and size + len(t) > most:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def aligned_texts(docs: DataFrame, folder: str = FOLDER, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(key, id, ``_RESULT``) of rows (id, text), stored: key tells rows apart; pairs
    (A id times the size of B's vocabulary, plus B id) are the row's distinct links."""
    spark, kind = docs.sparkSession, docs.schema["id"].dataType.simpleString()
    files = [Path(folder, name).read_bytes() for name in (BYTE_BPE, PIECE_BPE)]
    held = spark.sparkContext.broadcast(files)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, key = _built(*held.value), TaskContext.get().partitionId() << 34
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(1)):
                *numbers, sha, bounds, pairs, times = _align_slice(texts, tools)
                keys, key = np.arange(key, key + len(texts)), key + len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(2 * keys), batch.column(0).slice(at, len(texts)), *map(pa.array, numbers), pa.array(sha, pa.string()),
                     pa.ListArray.from_arrays(bounds, pa.array(pairs, pa.int64())),
                     pa.ListArray.from_arrays(bounds, pa.array(times, pa.int32()))], names=names)
                at += len(texts)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 34
        for batch in batches:
            for at, text in enumerate(batch.column(1)):
                parts = ranges(text.as_py(), range_bytes)
                columns = [pa.array(c) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([2 * key + 1] * len(parts)), batch.column(0).take(pa.array([at] * len(parts))),
                     pa.array(range(len(parts)), pa.int64()), *columns], names=["key", "id", "part", "low", "high", "start", "context"])
                key += 1

    def tokenize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tools = _built(*held.value)
        for batch in batches:
            for k in range(len(batch)):
                r = batch.iloc[k: k + 1]
                x = _range_fragment(*[r[c].iat[0] for c in ("low", "high", "start", "context")], tools)
                yield pd.DataFrame({"key": r["key"].array, "part": r["part"].array} | {c: [v] for c, v in _row(x).items()})

    def step(group: pd.DataFrame) -> pd.DataFrame:
        tools = _built(*held.value)
        group = group.sort_values("part")
        x = reduce(lambda p, q: compose(p, q, tools), map(_fragment_of, group.itertuples()))
        return pd.DataFrame({"key": group["key"].iloc[:1].array, "part": group["up"].iloc[:1].array} | {c: [v] for c, v in _row(x).items()})

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tools = _built(*held.value)
        for batch in batches:
            for r in batch.itertuples():
                x = finished(_fragment_of(r), tools)
                sha = hashlib.sha256(x.groups[:-1]).hexdigest() if x.n_groups else ""
                yield pd.DataFrame({"key": [r.key], "n_a": x.n_a, "n_b": x.n_b, "n_groups": x.n_groups, "n_links": x.n_links,
                                    "groups_sha256": sha, "pairs": [x.pairs], "times": [x.times.astype(np.int32)]})

    names = ["key", "id", *[c.split()[0] for c in _RESULT.split(", ")]]
    texts = docs.select("id", F.coalesce("text", F.lit("")).alias("text"))
    few = F.octet_length("text") <= range_bytes
    out = texts.where(few).mapInArrow(short, f"key long, id {kind}, {_RESULT}")
    parts = texts.where(~few).mapInArrow(split, f"key long, id {kind}, part long, low long, high long, start long, context string")
    parts = store(parts, "align-ranges")
    last = parts.agg(F.max("part")).first()[0]
    if last is not None:
        found = parts.drop("id").repartition("key", "part").mapInPandas(tokenize, f"key long, part long, {_FRAGMENT}")
        while last > 0:  # one level of the tree for each
            last //= FAN_IN
            found = found.withColumn("up", F.expr(f"part div {FAN_IN}")).groupBy("key", "up").applyInPandas(
                step, f"key long, part long, {_FRAGMENT}")
        whole = found.mapInPandas(close, f"key long, {_RESULT}")
        ids = parts.where("part = 0").select("key", "id")
        out = out.unionByName(whole.join(ids, "key"))
    return store(out, "align-texts")


def pair_counts(texts: DataFrame, width: int) -> DataFrame:
    """(pair, docs, best): the number of texts that link a pair, and whether its A id has no
    pair with more. Stored. An A id has at most ``width`` pairs, and there are no more A ids
    than the vocabulary holds, which bounds the broadcast."""
    counts = store(texts.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "align-pairs")
    a = F.expr(f"pair div {width}")
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    met = counts.withColumn("a", a).join(F.broadcast(most), "a")
    return store(met.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "align-counts")


def _hot_from(counts: DataFrame, most: int) -> tuple[int, bool]:
    """(least number of texts, a power of two, from which the pairs are at most ``most``;
    whether there are others)."""
    octaves = counts.groupBy(F.floor(F.log2("docs")).cast("int").alias("o")).agg(F.count(F.lit(1)).alias("n"))
    total, least = 0, 63
    for r in sorted(octaves.collect(), reverse=True):  # at most 63 rows
        total += r.n
        if total > most:
            return 1 << least, True
        least = r.o
    return 1, False


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER,
          range_bytes: int = RANGE_BYTES, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have
    no tokens: zeros and an empty digest. Texts of any length are aligned whole. Repeated
    rows, equal and null ids are texts of their own, also in the counts; all pairs that tie
    for an A id's highest count are best; an empty table gives no rows; other columns are
    not read.

    Links meet the counts of the ``hot_pairs`` most frequent pairs (a stated bound) in
    their task; only links of rarer pairs, each in few texts, are shuffled.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    texts = aligned_texts(rows, folder, range_bytes)
    counts = pair_counts(texts, _width(folder))
    least, more = _hot_from(counts, hot_pairs)
    hot = F.broadcast(counts.where(F.col("docs") >= least))
    links = texts.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("key", "l.*").withColumnRenamed("pairs", "pair")
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum")]
    per = links.join(hot, "pair").groupBy("key").agg(*sums)
    if more:
        rare = counts.where(F.col("docs") < least)
        rest = links.join(hot, "pair", "left_anti").join(rare.hint("merge"), "pair").groupBy("key").agg(*sums)
        per = per.unionByName(rest).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = texts.join(per, "key", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")


def _width(folder: str) -> int:
    """Size of B's vocabulary."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=str(Path(folder, PIECE_BPE))).get_piece_size()
