"""Encoding of whole texts with a byte-level BPE vocabulary.

Speculate and verify: for every distinct word a greedy longest match proposes tokens; a proposal is the true encoding exactly if
each of its adjacent token pairs is what the merges make of the pair's own bytes, and these checks are made for all proposals of
a batch at once, each distinct pair a single time. Only words with a failing pair undergo the merges themselves.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Words and pairs remembered by a task; beyond it the memory starts anew.
REMEMBERED = 1_000_000


def default_vocabulary() -> tuple[str, str]:
    """(path of the rank file, pattern that divides texts into words) of byte_bpe_50k."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def load_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.base = max(self.bytes_of, default=0) + 1
        # by first two bytes the lengths that tokens have, longest first
        lengths: dict[bytes, set[int]] = {}
        for b in ranks:
            lengths.setdefault(b[:2], set()).add(len(b))
        self.lengths = {k: sorted(v, reverse=True) for k, v in lengths.items()}
        self.words: dict[str, np.ndarray] = {}
        self.pairs: dict[int, bool] = {}

    def merge(self, word: bytes) -> list[int]:
        """The merges themselves: always the adjacent pair of least rank, the leftmost first."""
        n = len(word)
        start, end = list(range(n)), list(range(1, n + 1))
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        alive = [True] * n
        heap: list[tuple[int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j >= 0:
                rank = self.ranks.get(word[start[i] : end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, start[i], end[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, s, e = heapq.heappop(heap)
            j = after[s] if alive[s] else -1
            if j < 0 or end[j] != e:
                continue
            end[s], alive[j], after[s] = e, False, after[j]
            if after[j] >= 0:
                before[after[j]] = s
            push(s)
            if before[s] >= 0:
                push(before[s])
        return [self.ranks[word[start[i] : end[i]]] for i in range(n) if alive[i]]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match; every single byte is a token."""
        at, out = 0, []
        while at < len(word):
            for k in self.lengths.get(word[at : at + 2], ()):
                rank = self.ranks.get(word[at : at + k]) if at + k <= len(word) else None
                if rank is not None:
                    out.append(rank)
                    at += k
                    break
            else:
                out.append(self.ranks[word[at : at + 1]])
                at += 1
        return out

    def learn(self, words: list[str]) -> None:
        """Encodes words that aren't remembered."""
        if not words:
            return
        proposals = [np.array(self.propose(w.encode("utf-8", "surrogatepass")), np.int64) for w in words]
        sizes = np.array([len(p) for p in proposals], np.int64)
        flat = np.concatenate(proposals) if proposals else np.zeros(0, np.int64)
        # all adjacent pairs within words, and single tokens as pairs of themselves alone
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = owner[1:] == owner[:-1]
        left, right, of = flat[:-1][inner], flat[1:][inner], owner[1:][inner]
        alone = np.flatnonzero(sizes == 1)
        codes = np.concatenate((left * self.base + right, -1 - flat[np.concatenate(([0], np.cumsum(sizes)[:-1]))[alone]] if len(alone) else np.zeros(0, np.int64)))
        of = np.concatenate((of, alone))
        distinct, place = np.unique(codes, return_inverse=True)
        fits = np.array([self._fits(int(c)) for c in distinct], bool)
        failing = np.unique(of[~fits[place]]) if len(distinct) else np.zeros(0, np.int64)
        for i in failing:
            proposals[i] = np.array(self.merge(words[i].encode("utf-8", "surrogatepass")), np.int64)
        for w, p in zip(words, proposals, strict=True):
            self.words[w] = p.astype(np.int32)

    def _fits(self, code: int) -> bool:
        known = self.pairs.get(code)
        if known is None:
            tokens = [-1 - code] if code < 0 else [code // self.base, code % self.base]
            known = self.pairs[code] = self.merge(b"".join(self.bytes_of[t] for t in tokens)) == tokens
        return known

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets); null and empty texts have none."""
        if len(self.words) > REMEMBERED or len(self.pairs) > REMEMBERED:
            self.words.clear()
            self.pairs.clear()
        split = [self.pattern.findall(t) if t else [] for t in texts]
        self.learn([w for w in {w for ws in split for w in ws} if w not in self.words])
        parts = [self.words[w] for ws in split for w in ws]
        ends = np.cumsum([sum(len(self.words[w]) for w in ws) for ws in split])
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), np.concatenate(([0], ends))


def encode(df: DataFrame, key: str, text: str, vocabulary: str | None = None, pattern: str | None = None, ids: str = "ids") -> DataFrame:
    """(key, ids array<int>) of every row, by the rank file ``vocabulary``, without special tokens.

    The text is taken as it is, whole; strings of special tokens in it are ordinary text. Null and empty texts give an empty
    list. Map only: the vocabulary (its size is fixed) is read on the driver and broadcast.
    """
    path, own = (vocabulary, pattern) if vocabulary and pattern else default_vocabulary()
    path = vocabulary or path
    content = df.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    rule = pattern or own
    schema = T.StructType([df.schema[key], T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_ranks(content.value), rule)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                flat, offsets = encoder.encode_batch(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, pa.int32()))], names=[key, ids])

    return df.select(key, text).mapInArrow(scan, schema)
