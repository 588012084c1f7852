"""Encoding of a corpus with a public byte-level BPE vocabulary: speculate and verify.

A text is cut into words by the vocabulary's pattern; only words that a worker has not met yet are encoded. Greedy
longest match proposes their tokens. A sequence of tokens is what the merges give exactly when every adjacent pair
is what the merges give for the pair's own bytes, so all pairs of all new words are looked up at once in a table of
pairs (each pair is merged once); only words with a failing pair are merged in full.

Null and empty texts give the empty list. Strings that look like special tokens are plain text. Texts of any
length are processed whole; rows leave a worker in pieces, so a batch of long texts is never held twice.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the vocabulary's pattern, with its blanks spelled out as the Unicode property White_Space.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
#: Words and pairs that a worker remembers, and tokens after which it hands rows on.
WORDS, PAIRS, PIECE = 300_000, 1_000_000, 2_000_000


class Encoder:
    """The encoder of one worker."""

    def __init__(self, ranks_file: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines()) if a}
        self.token = {v: k for k, v in self.ranks.items()}
        self.longest: dict[int, int] = {}
        for t in self.ranks:
            self.longest[t[0]] = max(self.longest.get(t[0], 1), len(t))
        self.words: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.findall = regex.compile(PATTERN).findall

    def merged(self, word: bytes) -> tuple[int, ...]:
        """Exact merging: the adjacent pair of lowest rank first, the leftmost of equals."""
        ranks, pieces = self.ranks, [word[i : i + 1] for i in range(len(word))]
        while len(pieces) > 1:
            best, at = None, -1
            for i in range(len(pieces) - 1):
                r = ranks.get(pieces[i] + pieces[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        return tuple(ranks[p] for p in pieces)

    def merged_long(self, word: bytes) -> tuple[int, ...]:
        """As ``merged``, for long words: a heap of pairs over a linked list, so time is n log n."""
        import heapq

        ranks, n = self.ranks, len(word)
        start, end, nxt, prev = list(range(n)), list(range(1, n + 1)), [*range(1, n), -1], [-1, *range(n - 1)]
        alive, heap = [True] * n, []

        def push(i: int) -> None:
            j = nxt[i]
            if j >= 0 and (r := ranks.get(word[start[i] : end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[i], end[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, e, f = heapq.heappop(heap)
            if not alive[i] or end[i] != e or (j := nxt[i]) < 0 or end[j] != f:
                continue
            end[i], alive[j], nxt[i] = f, False, nxt[j]
            if nxt[i] >= 0:
                prev[nxt[i]] = i
            push(i)
            if prev[i] >= 0:
                push(prev[i])
        out, i = [], 0
        while i >= 0:
            out.append(ranks[word[start[i] : end[i]]])
            i = nxt[i]
        return tuple(out)

    def exact(self, word: bytes) -> tuple[int, ...]:
        return self.merged(word) if len(word) < 64 else self.merged_long(word)

    def greedy(self, word: bytes) -> list[int]:
        """Longest match from the left."""
        ranks, longest, out, at, n = self.ranks, self.longest, [], 0, len(word)
        while at < n:
            size = min(longest[word[at]], n - at)
            while (t := ranks.get(word[at : at + size])) is None:
                size -= 1
            out.append(t)
            at += size
        return out

    def fits(self, left: int, right: int) -> bool:
        return self.exact(self.token[left] + self.token[right]) == (left, right)

    def learn(self, new: list[str]) -> None:
        """Encode words that are not known yet."""
        if len(self.words) > WORDS:
            self.words.clear()
        proposed = [self.greedy(w.encode("utf-8", "replace")) for w in new]
        sizes = np.fromiter(map(len, proposed), np.int64, len(new))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(sizes.sum()))
        good = np.ones(len(new), bool)
        if len(flat) > 1:
            word = np.repeat(np.arange(len(new)), sizes)
            inner = word[1:] == word[:-1]
            pairs, back = np.unique((flat[:-1][inner] << 32) | flat[1:][inner], return_inverse=True)
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            table = self.pairs
            for p in pairs.tolist():
                if p not in table:
                    table[p] = self.fits(p >> 32, p & 0xFFFFFFFF)
            fit = np.fromiter((table[p] for p in pairs.tolist()), bool, len(pairs))[back]
            good[word[1:][inner][~fit]] = False
        for w, tokens, ok in zip(new, proposed, good.tolist(), strict=True):
            self.words[w] = tuple(tokens) if ok else self.exact(w.encode("utf-8", "replace"))

    def encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        """The ids of each text, in order. Words are learnt for some texts at a time, so that a batch is many pairs."""
        for begin in range(0, len(texts), 64):
            cut = [self.findall(t) if t else [] for t in texts[begin : begin + 64]]
            unknown = set(chain.from_iterable(cut)).difference(self.words)
            if unknown:
                if len(self.words) > WORDS:
                    self.words.clear()
                    unknown = set(chain.from_iterable(cut))
                self.learn(sorted(unknown))
            get = self.words.__getitem__
            for words in cut:
                yield list(chain.from_iterable(map(get, words)))


def _shared_vocabulary(df: DataFrame, vocabulary: str):
    """The vocabulary file (a public file of fixed size, below 2 MB) for all executors."""
    with open(vocabulary, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_column(df: DataFrame, id_column: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``id_column`` and ``ids`` (array<int>), one row for each row. No shuffle; other columns are not read."""
    shared = _shared_vocabulary(df, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            begin, flat, offsets = 0, [], [0]
            for row, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
                flat += ids
                offsets.append(len(flat))
                if len(flat) > PIECE or row == batch.num_rows - 1:
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.array(flat, np.int32), pa.int32()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, row + 1 - begin), lists], [id_column, "ids"])
                    begin, flat, offsets = row + 1, [], [0]

    kind = df.schema[id_column].dataType.simpleString()
    return df.select(id_column, text).mapInArrow(run, f"`{id_column}` {kind}, ids array<int>")


def count_tokens(df: DataFrame, keep: list[str], text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``n_tokens`` (long): the number of ids of ``encode_column``, 0 for null and empty."""
    shared = _shared_vocabulary(df, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            n = np.fromiter(map(len, encoder.encode(batch.column(len(keep)).to_pylist())), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n)], [*keep, "n_tokens"])

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)
    return df.select(*keep, F.col(text)).mapInArrow(run, f"{kinds}, n_tokens long")
