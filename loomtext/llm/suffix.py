"""Suffix-array removal of long byte strings that repeat across or within documents.

Every ``length``-byte string belongs to the smallest hash among its ``GRAM``-byte parts
(its minimizer), so equal strings meet under one key wherever they stand. Runs of
neighbouring starts with one minimizer form a segment. Segments whose key stands alone
cannot repeat; the others are sent by key to shards. Per shard a suffix array is built
by Larsson-Sadakane refinement, common prefixes follow from Kasai's rule, and starts
whose neighbours share ``length`` bytes are marked. A key too large for one shard is cut
into several; each pair of those is merged by binary search in the sorted digests of one
side's strings, and matches are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import store

LENGTH = 400
GRAM = 128  # bytes of a minimizer; a power of two below LENGTH
SHARD_BYTES = 1 << 20
SHARD_SEGMENTS = 1024  # distinct segments of one key in one shard, at most
_ODD = 0x9E3779B97F4A7C15
_MIX = 0xBF58476D1CE4E5B9
_WORDS = 1 << 64


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed polynomial hash of every ``gram`` bytes (a power of two) of ``data``."""
    h, p, k = data.astype(np.uint64) + np.uint64(1), _ODD, 1
    while k < gram:
        h = h[:-k] * np.uint64(p) + h[k:]
        p, k = p * p % _WORDS, 2 * k
    h ^= h >> np.uint64(29)
    h *= np.uint64(_MIX)
    return h ^ (h >> np.uint64(32))


def string_digests(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` bytes, put together from power-of-two parts."""
    out, at, n = np.zeros(len(data) - length + 1, np.uint64), 0, len(data) - length + 1
    for bit in reversed(range(length.bit_length())):
        if length >> bit & 1:
            out = out * np.uint64(_ODD) ^ gram_hashes(data, 1 << bit)[at: at + n]
            at += 1 << bit
    return out


def minimizer_runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(first start, starts, key, again) of the maximal runs of starts whose strings of
    ``length`` bytes have the same smallest gram hash; again: a run holds it twice."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    grams = gram_hashes(data, gram)
    low, k, window = grams, 1, length - gram + 1
    while 2 * k <= window:
        low, k = np.minimum(low[:-k], low[k:]), 2 * k
    if k < window:
        low = np.minimum(low[: len(low) - (window - k)], low[window - k:])
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    starts, key = np.diff(np.append(first, len(low))), low[first]
    again = [np.count_nonzero(grams[a: a + n + window - 1] == k) > 1
             for a, n, k in zip(first.tolist(), starts.tolist(), key, strict=True)]
    return first, starts, key, np.array(again, bool)


def packed(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one big-endian number, zeros past the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = padded[: len(data)].copy()
    for i in range(1, 8):
        out = (out << np.uint64(8)) | padded[i: i + len(data)]
    return out


def suffix_array(data: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """Larsson-Sadakane: sort by 8 bytes, then double the compared depth, sorting again
    only the groups that are still tied. The end of the data is below every byte."""
    n = len(data)
    words = packed(data) if words is None else words
    order = np.argsort(words, kind="stable").astype(np.int64)
    # zeros past the end tie with zero bytes; the shorter suffix comes first
    tail = np.arange(max(0, n - 8), n)
    head = np.concatenate([[True], words[order[1:]] != words[order[:-1]]])[:n]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    depth, tied = 8, _tied(head)
    if len(tail) and (data[tail] == 0).any():  # rare: start from single bytes instead
        order = np.argsort(data, kind="stable").astype(np.int64)
        head = np.concatenate([[True], data[order[1:]] != data[order[:-1]]])[:n]
        rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        depth, tied = 1, _tied(head)
    while len(tied):
        at = order[tied]
        further = at + depth
        key = rank[at] * (n + 1) + np.where(further < n, rank[np.minimum(further, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[tied] = at
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = np.maximum.accumulate(np.where(head, tied, 0))
        tied, depth = tied[_tied(head)], 2 * depth
    return order


def _tied(head: np.ndarray) -> np.ndarray:
    """Places in groups of two or more, given which places begin a group."""
    if not len(head):
        return np.empty(0, np.int64)
    return np.flatnonzero(~(head & np.append(head[1:], True)))


def common_prefixes(data: np.ndarray, order: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """Bytes that each suffix in ``order`` shares with the one before it (the first: 0).

    Kasai's rule in text order: if a suffix and its predecessor follow the same byte, it
    shares one byte less than the suffix one position earlier does. Only the others are
    compared, 8 bytes at a time, all at once."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    words = packed(data) if words is None else words
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    i = np.arange(n)
    compared = (before <= 0) | (i == 0)
    rest = np.flatnonzero(~compared)
    compared[rest] = data[rest - 1] != data[before[rest] - 1]
    shared = np.zeros(n, np.int64)
    live = np.flatnonzero(compared & (before >= 0))
    done = np.zeros(len(live), np.int64)
    while len(live):
        a, b = live + done, before[live] + done
        inside = np.maximum(a, b) < n
        diff = np.where(inside, words[np.minimum(a, n - 1)] ^ words[np.minimum(b, n - 1)], np.uint64(_WORDS - 1))
        equal = sum((diff >> np.uint64(8 * low) == 0).astype(np.int64) for low in range(8))
        shared[live] = np.minimum(done + equal, n - np.maximum(live, before[live]))
        go = inside & (diff == 0)
        live, done = live[go], done[go] + 8
    source = np.maximum.accumulate(np.where(compared, i, 0))
    return np.maximum(0, shared[source] - (i - source))[order]


def repeated_in_shard(data: np.ndarray, weight: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Positions whose ``length`` bytes occur at two or more counted positions; weight
    says how often a position counts (0: no string starts there)."""
    words = packed(data)
    order = suffix_array(data, words)
    group = np.cumsum(common_prefixes(data, order, words) < length) - 1
    counted = np.bincount(group, weight[order], minlength=1)
    out = np.zeros(len(data), bool)
    out[order] = counted[group] >= 2
    return out & (weight > 0)


def repeated_across(one: np.ndarray, one_starts: np.ndarray, two: np.ndarray, two_starts: np.ndarray,
                    length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Masks over the starts of two shards: strings that also start in the other shard.
    Binary search in one side's sorted digests, then a comparison of all bytes."""
    a, b = string_digests(one, length)[one_starts], string_digests(two, length)[two_starts]
    by = np.argsort(a)
    spot = np.minimum(np.searchsorted(a[by], b), max(0, len(a) - 1))
    met = np.flatnonzero(a[by][spot] == b) if len(a) else np.empty(0, np.int64)
    for at in range(0, len(met), 2048):
        part = met[at: at + 2048]
        x = one_starts[by[spot[part]]][:, None] + np.arange(length)
        y = two_starts[part][:, None] + np.arange(length)
        if not (one[x] == two[y]).all():
            raise ValueError("two strings with one 64-bit digest: change the hash multiplier")
    in_two = np.zeros(len(b), bool)
    in_two[met] = True
    return np.isin(a, b[met]), in_two


def segments(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, copy, start, starts, key, again, digest) of every segment of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, text in enumerate(batch.column(2)):
                data = text.as_buffer()
                first, starts, key, again = minimizer_runs(np.frombuffer(data, np.uint8), length, gram)
                view = memoryview(data)
                digest = [xxhash.xxh64_intdigest(view[a: a + n + length - 1], 7)
                          for a, n in zip(first.tolist(), starts.tolist(), strict=True)]
                rows.append((np.full(len(first), at), first, starts, key, again, np.array(digest, np.uint64)))
            at, first, starts, key, again, digest = \
                [np.concatenate(c) for c in zip(*rows, strict=True)] if rows else [np.empty(0)] * 6
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(first, pa.int64()), pa.array(starts, pa.int64()),
                 pa.array(key.astype(np.uint64).view(np.int64)), pa.array(again.astype(bool)),
                 pa.array(digest.astype(np.uint64).view(np.int64))],
                names=["id", "copy", "start", "starts", "key", "again", "digest"])

    kind = docs.schema["id"].dataType.simpleString()
    long = docs.where(F.octet_length("text") >= length).select("id", "copy", "text")
    return long.mapInArrow(run, f"id {kind}, copy long, start long, starts long, key long, again boolean, digest long")


def _shards(rows: DataFrame, length: int) -> DataFrame:
    """(key, digest, from, to): runs of repeated starts in the segments of each group of
    ``rows`` (part, key, side, digest, copies, bytes), where side tells two shards apart."""

    def marks(group: pd.DataFrame) -> list[tuple]:
        sizes = group["bytes"].map(len).to_numpy()
        begin = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(group["bytes"]), np.uint8)
        weight = np.zeros(len(data), np.int64)
        for at, size, copies in zip(begin, sizes, group["copies"], strict=True):
            weight[at: at + size - length + 1] = copies
        out = np.zeros(len(data), bool)
        if (group["side"] == group["side"].iloc[0]).all():
            out = repeated_in_shard(data, weight, length)
        else:  # two shards of one key, side by side
            cut = int(begin[int(np.argmax(group["side"].to_numpy()))])
            one, two = np.flatnonzero(weight[:cut]), np.flatnonzero(weight[cut:])
            in_one, in_two = repeated_across(data[:cut], one, data[cut:], two, length)
            out[one[in_one]] = True
            out[cut + two[in_two]] = True
        edge = np.diff(np.concatenate([[0], out.astype(np.int8), [0]]))
        found = []
        lows, highs = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        owner = np.searchsorted(begin, lows, side="right") - 1  # a run never leaves its segment
        for k, a, b in zip(owner.tolist(), lows.tolist(), highs.tolist(), strict=True):
            found.append((group["key"].iat[k], group["digest"].iat[k], a - int(begin[k]), b - int(begin[k])))
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size, last = 0, None

        def flush() -> pd.DataFrame:
            rows = pd.concat(held, ignore_index=True)
            found = []
            for _, both in rows[rows["pair"]].groupby("part"):
                found += marks(both.sort_values("side", kind="stable").reset_index(drop=True))
            if (~rows["pair"]).any():
                found += marks(rows[~rows["pair"]].assign(side=0).reset_index(drop=True))
            return pd.DataFrame(found, columns=["key", "digest", "from", "to"]).astype("int64")

        for batch in batches:
            for part, group in batch.groupby("part", sort=False):
                if part != last and size >= SHARD_BYTES:
                    yield flush()
                    held, size = [], 0
                held.append(group)
                size, last = size + int(group["bytes"].map(len).sum()), part
        if held:
            yield flush()

    return rows.mapInPandas(run, "key long, digest long, `from` long, `to` long")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """(id, copy, spans): per text (id, copy, text) the byte ranges [from, to) covered by
    repeated strings, unmerged; texts without any are absent."""
    runs = store(segments(docs, length, gram), "suffix-segments")
    seen = runs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # a segment that holds its minimizer twice may repeat itself
    inner = F.col("again")
    shared = runs.join(seen, "key", "left").where(F.col("n").isNotNull() | inner).drop("n")
    shared = store(shared, "suffix-shared")
    # copies of a segment fold before anything else; one of them stands for all
    kinds = shared.groupBy("key", "digest", "starts", "again").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "copy", "start")).alias("src"))
    kinds = store(kinds, "suffix-kinds")
    per_key = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    todo = kinds.join(per_key, "key").where((F.col("kinds") > 1) | ((F.col("copies") == 1) & inner))
    wanted = todo.groupBy(F.col("src.id").alias("_id"), F.col("src.copy").alias("_copy")).agg(F.collect_list(
        F.struct(F.col("src.start").alias("start"), "starts", "key", "digest", "copies", "kinds")).alias("want"))
    # of rows that repeat an id and a text one is cut, for all
    named = F.col("id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy"))
    again = docs.groupBy("id", "copy").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("id").alias("_i"), F.col("copy").alias("_c"), F.lit(True).alias("again"))
    wanted = store(wanted.join(again, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_copy") == F.col("_c")), "left"), "suffix-wanted")
    once = docs.join(wanted.where("again is null"), named).select("text", "want")
    many = docs.join(wanted.where("again"), named).groupBy("id", "copy").agg(F.first("text").alias("text"), F.first("want").alias("want"))
    texts = once.unionByName(many.select("text", "want"))
    cut = F.transform("want", lambda s: F.struct(
        s["key"].alias("key"), s["digest"].alias("digest"), s["copies"].alias("copies"), s["kinds"].alias("kinds"),
        F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["starts"] + length - 1).cast("int")).alias("bytes")))
    pieces = texts.select(cut.alias("cut")).select(F.explode("cut").alias("s")).select("s.*")
    pieces = pieces.withColumn("shards", F.ceil(F.col("kinds") / shard_segments).cast("int"))
    pieces = pieces.withColumn("side", F.pmod("digest", F.col("shards")).cast("int"))
    pieces = pieces.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    part = F.when(F.col("shards") == 1, F.col("key")).otherwise(
        F.xxhash64("key", F.least("side", "other"), F.greatest("side", "other")))
    dealt = pieces.select(part.alias("part"), "key", "side", (F.col("side") != F.col("other")).alias("_cross"),
                          ((F.col("shards") > 1) & (F.col("side") != F.col("other"))).alias("pair"), "digest", "copies", "bytes")
    dealt = dealt.drop("_cross").repartition("part").sortWithinPartitions("part")
    found = _shards(dealt, length)
    whole = kinds.where("copies > 1").select("key", "digest", F.lit(0).cast("long").alias("from"), F.col("starts").alias("to"))
    ranges = found.union(whole).groupBy("key", "digest").agg(F.collect_set(F.struct("from", "to")).alias("ranges"))
    at = shared.dropDuplicates(["id", "copy", "start"]).join(ranges, ["key", "digest"]).select("id", "copy", F.transform("ranges", lambda r: F.struct(
        (F.col("start") + r["from"]).alias("from"), (F.col("start") + r["to"] + (length - 1)).alias("to"))).alias("spans"))
    return at.groupBy("id", "copy").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, kept (the
    bytes that remain).

    Null and empty texts, and texts shorter than ``length`` bytes, lose nothing; texts of
    any length are read whole. Rows that repeat an id and a text are copies of each other
    like any two documents. A null id is an id of its own; an empty table gives no rows;
    other columns, whatever their names, are not read.
    """
    text = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("copy", F.xxhash64("text"))
    spans = repeated_spans(rows, length, gram, shard_segments)
    spans = spans.select(F.col("id").alias("_id"), F.col("copy").alias("_copy"), "spans")
    met = rows.join(spans, F.col("id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy")), "left")
    ends = F.coalesce(F.flatten(F.transform("spans", lambda s: F.array(s["from"], s["to"]))), F.array().cast("array<bigint>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ends in zip(batch.column(1), batch.column(2), strict=True):
                data, bounds, gone, runs, at, kept = text.as_buffer(), ends.values.to_numpy(zero_copy_only=False), 0, 0, 0, []
                view = memoryview(data)
                for a, b in zip(bounds[0::2].tolist(), bounds[1::2].tolist(), strict=True):
                    if a > at or not runs:
                        kept.append(view[at:a])
                        runs += 1
                        gone += b - a
                    else:
                        gone += max(0, b - at)
                    at = max(at, b)
                kept.append(view[at:])
                left = b"".join(kept)
                out.append((len(view), gone, runs, hashlib.sha256(left).hexdigest(), left))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], names=names)

    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kind = docs.schema[id_col].dataType.simpleString()
    return met.select("id", "text", ends.alias("ends")).mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
