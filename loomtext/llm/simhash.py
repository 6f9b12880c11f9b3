"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 two-bit segments; its embedding is the vector of
segment bit counts (0, 1 or 2), kept as one 64-bit thermometer code (00, 01, 11), so the
Manhattan distance of two embeddings is the bit count of the XOR of their codes and
never exceeds the Hamming distance of the fingerprints. The segments form ``r + 3``
groups: two points within Manhattan distance r agree on at least 3 whole groups, so each
point enters the grid cell of every choice of 3 groups, and a cell is joined with itself:
first the Manhattan bound, then the exact Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import connected_components, forest, store

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 32
SAME_GROUPS = 3
# Members of a cell that one task compares with each other; larger cells are cut into
# blocks, and every pair of blocks is compared in a group of its own.
CELL_BLOCK = 384
_EVEN = 0x5555555555555555


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of one text (0 without words)."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) < words:
        hashes = np.array([digest(joined, seed)], np.uint64)
    else:
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lengths + 1) - 1
        spans = zip((ends - lengths)[: len(parts) - words + 1].tolist(), ends[words - 1:].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(parts) - words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at: at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp) for every row; fp holds the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=[id_col, "fp"])

    rows = docs.select(id_col, F.col(text_col).cast("string"))
    return rows.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fp long")


def thermometer(fp: Column) -> Column:
    """Segment bit counts 0, 1, 2 as 00, 01, 11: the embedding in one long."""
    even = F.lit(_EVEN)
    upper = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(upper).bitwiseAND(even)
    both = fp.bitwiseAND(upper).bitwiseAND(even)
    return some.bitwiseOR(F.shiftleft(both, 1))


def cell_masks(max_bits: int = MAX_BITS) -> list[int]:
    """One mask of code bits for each choice of groups that may agree as a whole."""
    parts = np.array_split(np.arange(SEGMENTS), max_bits + SAME_GROUPS)
    masks = [sum(3 << int(2 * s) for s in p) for p in parts]
    return [sum(c) for c in combinations(masks, SAME_GROUPS)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def link_edges(fps: DataFrame, max_bits: int = MAX_BITS, block: int = CELL_BLOCK) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column fp) that connect exactly what
    pairs at ``max_bits`` or fewer differing bits connect; a spanning forest per batch
    of cells, never all pairs of a cell."""
    coded = fps.select("fp", thermometer(F.col("fp")).alias("code"))
    cells = F.array(*[F.struct(F.lit(i).alias("g"), F.col("code").bitwiseAND(F.lit(_signed(m))).alias("cell"))
                      for i, m in enumerate(cell_masks(max_bits))])
    keyed = coded.select("fp", "code", F.explode(cells).alias("k")).select("fp", "code", "k.g", "k.cell")
    shared = keyed.groupBy("g", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = keyed.join(shared, ["g", "cell"]).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    placed = placed.withColumn("side", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # in the pair (i, j) of blocks, i <= j; a cell in one block is the pair (0, 0)
    paired = placed.select("g", "cell", "fp", "code", "side", partner.alias("other")).select(
        F.xxhash64("g", "cell", F.least("side", "other"), F.greatest("side", "other")).alias("key"), "fp", "code")
    dealt = paired.repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = np.empty((3, 0), np.int64)
        for last, batch in _with_last(batches):
            if batch is not None:
                rest = np.concatenate([rest, batch[["key", "fp", "code"]].to_numpy(np.int64).T], axis=1)
            cut = rest.shape[1] if last else int(np.searchsorted(rest[0], rest[0, -1])) if rest.shape[1] else 0
            ready, rest = rest[:, :cut], rest[:, cut:]
            u, v = close_pairs(*ready, max_bits)
            yield pd.DataFrame(dict(zip("uv", forest(u, v), strict=True)))

    return dealt.mapInPandas(run, "u long, v long")


def _with_last(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bool, pd.DataFrame | None]]:
    for batch in batches:
        if len(batch):
            yield False, batch
    yield True, None


def close_pairs(key: np.ndarray, fp: np.ndarray, code: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of rows with equal keys (sorted) within max_bits; every pair of such
    rows is compared, all cells at once, one row distance after the other."""
    us, vs = [fp[:0]], [fp[:0]]
    at, step = np.arange(len(key)), 0
    while len(at):
        step += 1
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        near = at[np.bitwise_count((code[at] ^ code[at + step]).view(np.uint64)) <= max_bits]
        near = near[np.bitwise_count((fp[near] ^ fp[near + step]).view(np.uint64)) <= max_bits]
        us.append(fp[near])
        vs.append(fp[near + step])
    return np.concatenate(us), np.concatenate(vs)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of ``max_bits`` or fewer
    differing bits. Null and empty texts have fingerprint zero and link like others;
    repeated rows each give a row; rows with a null id take part but never name a
    component (it is null if all its ids are); an empty table gives no rows; other
    columns of ``docs`` are ignored.
    """
    marked = store(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = store(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct-fingerprints")
    linked = connected_components(link_edges(distinct, max_bits))
    labelled = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("component", F.coalesce("component", "fp"))
    named = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = labelled.join(named, "component").select("fp", "component_id")
    out = marked.join(classes, "fp")
    return out.select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
