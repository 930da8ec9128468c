"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Spark deals documents to tasks in slices; merges are replayed over *all distinct words of a slice at once*.
An inverted index maps the rank of a token pair to the word positions where the pair stands. Ranks are taken in
order; each applies to all its positions and touches only the two neighbours of every merge, which enter the
index under their own ranks. Since a word's merges depend on no other word, replaying slice by slice gives the
ids that one replay over the whole corpus would give, with memory bounded by the slice and no shuffle. Words
already replayed by a worker are remembered up to a limit.

Nulls count as empty and give no ids; rows, also repeated ones, are kept one for one; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as tx

CACHE, PAIRS = 400_000, 500_000  # words and pairs that a worker remembers


class Replay:
    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.match = regex.compile(pattern).findall
        self.single = [self.ranks.get(bytes([b]), -1) for b in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}
        self.known: dict[str, bytes] = {}  # ids as 32-bit integers

    def rank(self, left: int, right: int) -> int:
        """Rank of the token that the pair merges to, or -1."""
        got = self.pairs.get((left, right))
        if got is None:
            got = self.pairs[left, right] = self.ranks.get(self.bytes_of[left] + self.bytes_of[right], -1)
        return got

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Ids of every word. The words' bytes lie in one row of symbols linked to their neighbours."""
        symbols, after, before, word_of, begin = (array("i") for _ in range(5))
        index: dict[int, array] = {}
        rank = self.rank
        for w, word in enumerate(words):
            at = len(symbols)
            begin.append(at)
            symbols.extend(self.single[b] for b in word)
            n = len(word)
            before.append(-1)
            before.extend(range(at, at + n - 1))
            after.extend(range(at + 1, at + n))
            after.append(-1)
            word_of.extend(array("i", [w]) * n)
            for i in range(at, at + n - 1):
                if (r := rank(symbols[i], symbols[i + 1])) >= 0:
                    index.setdefault(r, array("i")).append(i)
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            places = index.pop(r, None)
            if not places:
                continue
            wait, put_back = -1, []
            for i in sorted(places):
                j = after[i]
                if symbols[i] < 0 or j < 0 or rank(symbols[i], symbols[j]) != r:
                    continue  # an earlier merge took part of the pair
                if word_of[i] == wait:
                    put_back.append(i)
                    continue
                symbols[i], symbols[j] = r, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    if (s := rank(r, symbols[k])) >= 0:
                        if s not in index:
                            heapq.heappush(heap, s)
                        index.setdefault(s, array("i")).append(i)
                        if s < r:
                            wait = word_of[i]  # in this word the lower rank comes first
                h = before[i]
                if h >= 0 and (s := rank(symbols[h], r)) >= 0:
                    if s not in index:
                        heapq.heappush(heap, s)
                    index.setdefault(s, array("i")).append(h)
                    if s < r:
                        wait = word_of[i]
            if put_back:
                if r not in index:
                    heapq.heappush(heap, r)
                index.setdefault(r, array("i")).extend(put_back)
        out = []
        for i in begin:
            ids = []
            while i >= 0:
                ids.append(symbols[i])
                i = after[i]
            out.append(ids)
        return out

    def learn(self, words: set[str]) -> None:
        """Replays the merges over the words that are not known yet."""
        if len(self.known) > CACHE:
            self.known.clear()
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        new, rest = [], []
        for w in words:
            if w not in self.known:
                b = w.encode()
                if b in self.ranks:  # a match that is a token needs no merge
                    self.known[w] = array("i", [self.ranks[b]]).tobytes()
                else:
                    new.append(w)
                    rest.append(b)
        for w, ids in zip(new, self.merge(rest), strict=True):
            self.known[w] = array("i", ids).tobytes()

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all documents and the id bounds of the documents."""
        starts, ends, bounds = tx.units(data, off)
        picks, distinct = tx.codes(data, starts, ends)
        if not distinct:
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        matches = [self.match(u) for u in distinct]
        self.learn({m for found in matches for m in found})
        known = self.known
        ids = [b"".join([known[m] for m in found]) for found in matches]
        lens = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, to = tx.gather(np.frombuffer(b"".join(ids), np.int32), np.cumsum(lens) - lens, lens, picks)
        return flat, to[bounds]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def loaded(path: str, pattern: str) -> Replay:
    return tx.warm(("replay", path, pattern), lambda: Replay(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = loaded(path, pattern)
        for rows, data, off in tx.slices(batches):
            flat, bounds = replay.encode(data, off)
            ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), ids], ["doc_id", "ids"])

    tx.small_batches(docs.sparkSession)
    return tx.keyed(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, decoded (binary): the bytes that the ids stand for; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = loaded(path, pattern)
        for rows in batches:
            ids = rows.column("ids")
            texts = [None if x is None or not x.is_valid else replay.decode(x.values.to_numpy(zero_copy_only=False)) for x in ids]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), ids, pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
