"""Token counts by trie-shared dynamic programming.

A unigram model scores each piece of a public vocabulary; a pre-token (a word with the
blank before it) is cut where the sum of scores is largest. The distinct pre-tokens of a
batch form a trie, and the forward scores of a prefix are computed once for all words
that begin with it, all prefixes of one length together in numpy; the token counts stand
at the words' last nodes. Below ``DEEP`` bytes, where few words are left, the trie is
walked depth first in word order instead, with the scores of the path at hand.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CHUNK_WORDS = 1 << 17  # distinct pre-tokens in one trie, at most
DEEP = 64  # levels of the trie that are solved whole; deeper nodes are walked depth first


class Unigram:
    """Pieces (byte strings, all 256 bytes among them) with scores, as a trie in arrays."""

    def __init__(self, pieces: list[tuple[bytes, float]]):
        # breadth first by length, so children of a node level come together
        self.child = np.zeros((1, 256), np.int32)
        nodes, children, scores = {b"": 0}, [], [-np.inf]
        for piece, score in pieces:
            for end in range(1, len(piece) + 1):
                if piece[:end] not in nodes:
                    children.append((nodes[piece[: end - 1]], piece[end - 1], len(nodes)))
                    nodes[piece[:end]] = len(nodes)
                    scores.append(-np.inf)
            scores[nodes[piece]] = score
        self.child = np.zeros((len(nodes), 256), np.int32)  # 0: no such child
        if children:
            parent, byte, node = np.array(children).T
            self.child[parent, byte] = node
        self.step = {p << 8 | b: n for p, b, n in children}  # the same, for single steps
        self.score = np.array(scores)
        self.value = scores
        self.longest = max((len(p) for p, _ in pieces), default=1)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Tokens of the best cut of each of the sorted, distinct ``words``; ties take
        fewer tokens. No prefix is scored twice."""
        out = np.zeros(len(words), np.int64)
        if not words:
            return out
        lengths = np.array([len(w) for w in words])
        width = min(int(lengths.max()), DEEP)
        raw = np.frombuffer(b"".join(w[:width].ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        same = np.zeros((len(words), width), bool)  # shares this and all earlier bytes with the word before
        if width:
            same[1:] = np.logical_and.accumulate(raw[1:] == raw[:-1], axis=1)
            same[1:] &= np.arange(width) < np.minimum(lengths[1:], lengths[:-1])[:, None]
        at = np.zeros(len(words), np.int64)  # each word's node at the current depth
        # per depth: forward score and token count of every node
        forward, tokens = [np.zeros(1)], [np.zeros(1, np.int64)]
        starts = [(0, np.zeros(1, np.int64))]  # per start offset: (offset, vocabulary node for each node)
        up = []  # per depth: each node's parent
        for depth in range(width):
            reach = lengths > depth
            new = reach & ~same[:, depth]
            rows = np.flatnonzero(new)
            parent, byte = at[rows], raw[rows, depth]
            up.append(parent)
            moved = []
            best, used = np.full(len(rows), -np.inf), np.zeros(len(rows), np.int64)
            back = np.arange(len(rows))  # each node's ancestor at the start offset, from the nearest offset on
            level = depth + 1
            for offset, state in reversed(starts):
                while level > offset:
                    level -= 1
                    back = up[level][back]
                state = self.child[state[parent], byte]
                moved.append((offset, state))
                live = np.flatnonzero(state)
                score = forward[offset][back[live]] + self.score[state[live]]
                n = tokens[offset][back[live]] + 1
                wins = (score > best[live]) | ((score == best[live]) & (n < used[live]))
                best[live[wins]], used[live[wins]] = score[wins], n[wins]
            forward.append(best)
            tokens.append(used)
            # node 0 is the vocabulary's root: a dead start stays dead by pointing at a leaf
            starts = [(o, np.where(s > 0, s, self.dead)) for o, s in reversed(moved) if o > depth - self.longest and s.any()]
            starts.append((depth + 1, np.zeros(len(rows), np.int64)))
            place = np.cumsum(new) - 1
            at = np.where(reach, place, at)
            ends = np.flatnonzero(lengths == depth + 1)
            out[ends] = used[at[ends]]
        deep = np.flatnonzero(lengths > width)

        def heads() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for first in range(0, len(deep), 1024):
                nodes, head = at[deep[first: first + 1024]], []
                for level in range(width, -1, -1):
                    head.append((forward[level][nodes], tokens[level][nodes]))
                    nodes = up[level - 1][nodes] if level else nodes
                yield from zip(*[np.stack(x, axis=1) for x in zip(*reversed(head), strict=True)], strict=True)

        out[deep] = self._walk([words[i] for i in deep], heads())
        return out

    def _walk(self, words: list[bytes], heads: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[int]:
        """Tokens of the sorted ``words``, whose first offsets have the scores and token
        counts ``heads``: down the path of each from where it leaves the word before."""
        out, last = [], b""
        path: list[tuple[float, int]] = []
        for word, (score, n) in zip(words, heads, strict=True):
            known = _shared(word, last) if path else 0
            if known < len(score):
                path, known = list(zip(score.tolist(), (-n).tolist(), strict=True)), len(score) - 1
            del path[known + 1:]
            path += [(-np.inf, 0)] * (len(word) - known)
            for a in range(max(0, known + 1 - self.longest), len(word)):
                node, (value, taken) = 0, path[a]
                for b in range(a, min(len(word), a + self.longest)):
                    node = self.step.get(node << 8 | word[b])
                    if node is None:
                        break
                    if b >= known:
                        path[b + 1] = max(path[b + 1], (value + self.value[node], taken - 1))
            out.append(-path[-1][1])
            last = word
        return out

    @property
    def dead(self) -> int:
        """A vocabulary node without children and so without a way on."""
        if not hasattr(self, "_dead"):
            self._dead = int(np.flatnonzero(~self.child.any(axis=1))[0])
        return self._dead


def _shared(a: bytes, b: bytes) -> int:
    """Bytes that both begin with."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def zipf_pieces(path: str = VOCABULARY) -> list[tuple[bytes, float]]:
    """The pieces of a rank file ("base64 rank" lines) with unigram log scores after
    Zipf's law: the piece of rank r has a share in proportion to 1 / (r + 2)."""
    with open(path, "rb") as lines:
        ranks = [(base64.b64decode(a), int(b)) for a, b in (x.split() for x in lines if x.strip())]
    total = sum(1 / (r + 2) for _, r in ranks)
    return [(p, float(-np.log((r + 2) * total))) for p, r in ranks]


@cache
def model(path: str) -> Unigram:
    return Unigram(zipf_pieces(path))


def pre_tokens(text: bytes) -> list[bytes]:
    """Words with the one blank before them; a line end stands alone. Joined, they are
    the text again."""
    out: list[bytes] = []
    for line in text.split(b"\n"):
        head, *rest = line.split(b" ")
        if head:
            out.append(head)
        out += [b" " + w for w in rest]
        out.append(b"\n")
    return out[:-1]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per input row: id, n_tokens, n_pre_tokens, n_distinct (pre-tokens).

    Null and empty texts have no tokens; repeated rows and null ids each give a row; an
    empty table gives no rows; other columns, whatever their names, are ignored. A text is
    never cut, nor a pre-token of any length; a trie is solved when it holds
    ``CHUNK_WORDS`` distinct pre-tokens. Every executor reads the vocabulary file from
    ``vocabulary``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram = model(vocabulary)
        for batch in batches:
            known: dict[bytes, int] = {}
            solved = np.zeros(0, np.int64)
            rows: list = []
            held: list = []

            def solve(held: list, known: dict, rows: list) -> None:
                words = sorted(known)
                place = np.empty(len(words), np.int64)
                place[[known[w] for w in words]] = unigram.counts(words)
                for ids in held:
                    rows.append((int(place[ids].sum()), len(ids), len(np.unique(ids))))

            for text in batch.column(1):
                words = pre_tokens(text.as_py() or b"")
                held.append(np.array([known.setdefault(w, len(known)) for w in words], np.int64))
                if len(known) >= CHUNK_WORDS:
                    solve(held, known, rows)
                    known, held = {}, []
            if held:
                solve(held, known, rows)
            columns = list(zip(*rows, strict=True)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], names=names)

    names = [id_col, "n_tokens", "n_pre_tokens", "n_distinct"]
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.encode(F.col(text_col).cast("string"), "utf-8")
    return docs.select(id_col, text.alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, n_pre_tokens long, n_distinct long")
