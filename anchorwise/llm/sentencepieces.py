"""SentencePiece BPE encoding and decoding through a table of distinct marked words.

No piece of the vocabulary holds a white-space marker after another character, so no merge crosses from the end of a word to
the marker of the next: a text falls into chunks, each one or more markers and the characters up to the next marker.
Spark deals documents to tasks in slices of whole texts. A slice's distinct chunks make a table, each is segmented once, and
ids are joined back by position; chunks that a slice holds twice or more stay known to the worker, up to ``KNOWN`` of
them. Nothing is shuffled: one table for the whole corpus would move each slice's distinct chunks and their answers.

A chunk begins as its characters. Of all neighbours whose joint string is a piece, the pair with the highest score, the
leftmost of equals, becomes one symbol, until no pair is a piece. A block's chunks take their merges in step, one
a round each, as arrays; a chunk of more than ``LONG`` characters goes through a heap. Characters without a piece become
the byte pieces of their UTF-8 form.

Made for BPE models with byte fallback, dummy prefix, whole white space and without normalisation; others are refused where
the vocabulary tells. Null counts as empty; empty texts have no ids and decode to the empty string. Rows, also repeated ones
and those without an id, are kept one for one; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import text as tx

MARK, LONG, ROUND = "▁", 48, 20_000
UNKNOWN = " ⁇ ".encode()  # a fixed value: the library's text for the unknown id
KNOWN = 200_000  # chunks that a worker remembers
NO_PAIR = np.iinfo(np.int32).max


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.piece = [model.id_to_piece(i) for i in ids]
        self.byte = {int(self.piece[i][1:-1], 16): i for i in ids if model.is_byte(i)}
        self.control = {i for i in ids if model.is_control(i)}
        self.unknown = model.unk_id()
        normal = {self.piece[i]: i for i in ids if i not in self.control and i != self.unknown and not model.is_byte(i) and not model.is_unused(i)}
        if len(self.byte) != 256 or any(MARK in p.lstrip(MARK) for p in normal) or model.encode(" a") != model.encode(MARK + "a"):
            raise ValueError(f"{path}: not a byte-fallback model whose pieces stay within marked words")
        self.symbol = dict(normal)  # strings to numbers: ids, and further ones for characters that stand in pieces only
        for c in sorted({c for p in normal for c in p}):
            self.symbol.setdefault(c, len(self.piece) + len(self.symbol))
        self.width = 2 * len(self.piece) + len(self.symbol)
        score = {p: model.get_score(i) for p, i in normal.items()}
        rank = {x: k for k, x in enumerate(sorted(set(score.values()), reverse=True))}
        self.pairs: dict[int, tuple[int, int]] = {}  # the piece that two symbols make: rank of its score, id
        for p, i in normal.items():
            for k in range(1, len(p)):
                left, right = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if left is not None and right is not None:
                    self.pairs[left * self.width + right] = rank[score[p]], i
        keys = sorted(self.pairs)
        self.keys = np.array([*keys, -1], np.int64)
        self.ranks, self.made = (np.array([*(self.pairs[k][x] for k in keys), NO_PAIR], np.int64) for x in (0, 1))
        self.of_point = np.full(0x110000, -1, np.int64)
        for c, s in self.symbol.items():
            if len(c) == 1:
                self.of_point[ord(c)] = s
        self.of_point[0x20] = self.symbol[MARK]

    def joint(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and ids of the pieces that pairs of symbols make; NO_PAIR where they make none."""
        key = left * self.width + right
        key[(left < 0) | (right < 0)] = -2
        at = np.searchsorted(self.keys[:-1], key)
        at[self.keys[at] != key] = len(self.keys) - 1
        return self.ranks[at], self.made[at]

    def segment(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all chunks and their bounds."""
        parts, sizes = [], []
        for lo in range(0, len(found), ROUND):
            flat, bounds = self._segment(found.slice(lo, ROUND))
            parts.append(flat)
            sizes.append(np.diff(bounds))
        sizes = np.concatenate([[0], *sizes]).astype(np.int64)
        return np.concatenate([np.zeros(0, np.int64), *parts]), np.cumsum(sizes)

    def _segment(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(found.to_pylist()).encode("utf-32-le"), np.uint32)
        lens = pc.utf8_length(found).to_numpy().astype(np.int64)
        symbols = self.of_point[points]
        first = np.cumsum(lens) - lens
        done_at, done = [], []  # places of the symbols that remain, and the symbols
        long = np.flatnonzero(lens > LONG)
        for k in long.tolist():
            at, got = self._by_heap(symbols[first[k] : first[k] + lens[k]].tolist())
            done_at.append(np.array(at, np.int64) + first[k])
            done.append(np.array(got, np.int64))
        chunk = np.repeat(np.arange(len(lens)), np.where(lens > LONG, 0, lens))
        place = np.flatnonzero(np.repeat(lens <= LONG, lens))
        symbols = symbols[place]
        follows = np.append(chunk[1:] == chunk[:-1], False)
        rank, made = (np.full(len(symbols), NO_PAIR, np.int64) for _ in range(2))
        inner = np.flatnonzero(follows)
        rank[inner], made[inner] = self.joint(symbols[inner], symbols[inner + 1])
        while len(symbols):
            heads = np.flatnonzero(np.diff(chunk, prepend=-1))
            best = np.minimum.reduceat(rank, heads)
            size = np.diff(heads, append=len(symbols))
            open_ = np.repeat(best < NO_PAIR, size)
            done_at.append(place[~open_])
            done.append(symbols[~open_])
            hit = open_ & (rank == np.repeat(best, size))
            symbols, place, chunk, rank, made, hit = (x[open_] for x in (symbols, place, chunk, rank, made, hit))
            at = np.flatnonzero(hit)
            at = at[np.flatnonzero(np.diff(chunk[at], prepend=-1))]  # the leftmost of each chunk
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, place, chunk, rank, made = (x[keep] for x in (symbols, place, chunk, rank, made))
            at -= np.arange(len(at))
            for left in (at, at - 1):
                left = left[left >= 0]
                right = np.minimum(left + 1, len(symbols) - 1)
                same = (right > left) & (chunk[left] == chunk[right])
                rank[left], made[left] = self.joint(np.where(same, symbols[left], -1), symbols[right])
        at = np.concatenate([np.zeros(0, np.int64), *done_at])
        order = np.argsort(at, kind="stable")
        at, ids = at[order], np.concatenate([np.zeros(0, np.int64), *done])[order]
        bounds = np.searchsorted(at, np.append(first, len(points)))
        odd = np.flatnonzero((ids < 0) | (ids >= len(self.piece)))
        if len(odd):  # characters without a piece: bytes instead
            bytes_of = [[self.byte[b] for b in chr(points[k]).encode()] for k in at[odd].tolist()]
            more = np.zeros(len(ids) + 1, np.int64)
            more[odd + 1] = [len(b) - 1 for b in bytes_of]
            more = np.cumsum(more)
            out = np.full(len(ids) + more[-1], -1, np.int64)
            out[np.arange(len(ids)) + more[:-1]] = ids
            for k, b in zip((odd + more[odd]).tolist(), bytes_of, strict=True):
                out[k : k + len(b)] = b
            ids, bounds = out, bounds + more[bounds]
        return ids, bounds

    def _by_heap(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """Places and symbols that remain of one chunk."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        pairs, width, none = self.pairs, self.width, (-1, -1)

        def joint(a: int, b: int) -> tuple[int, int]:
            return pairs.get(a * width + b, none) if a >= 0 and b >= 0 else none

        heap = [(r, i) for i in range(n - 1) if (r := joint(symbols[i], symbols[i + 1])[0]) >= 0]
        heapq.heapify(heap)
        gone = -2
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if symbols[i] == gone or j < 0:
                continue
            now, piece = joint(symbols[i], symbols[j])
            if now != r:
                continue
            symbols[i], symbols[j] = piece, gone
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (s := joint(piece, symbols[k])[0]) >= 0:
                    heapq.heappush(heap, (s, i))
            h = before[i]
            if h >= 0 and (s := joint(symbols[h], piece)[0]) >= 0:
                heapq.heappush(heap, (s, h))
        left = [i for i in range(n) if symbols[i] != gone]
        return left, [symbols[i] for i in left]


class Table:
    """The distinct chunks of slices and their ids."""

    def __init__(self, path: str, known: int = KNOWN):
        self.pieces, self.limit = Pieces(path), known
        self._forget()

    def _forget(self) -> None:
        self.known, self.flat, self.bounds = pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all marked texts, and the id bounds of the texts."""
        starts, bounds = cut(data, off)
        coded = tx.coded(data, starts, np.append(starts[1:], len(data)))
        picks, distinct = coded.indices.to_numpy(), coded.dictionary
        at = pc.fill_null(pc.index_in(distinct, value_set=self.known), -1).to_numpy()
        new = np.flatnonzero(at < 0)
        fresh = distinct.take(pa.array(new))
        flat, to = self.pieces.segment(fresh)
        where = at.astype(np.int64)
        where[new] = len(self.known) + np.arange(len(new))
        begin, lens = np.append(self.bounds[:-1], to[:-1] + len(self.flat)), np.append(np.diff(self.bounds), np.diff(to))
        ids, ends = tx.gather(np.append(self.flat, flat), begin, lens, where[picks])
        often = np.flatnonzero(np.bincount(picks, minlength=len(distinct))[new] > 1)
        if len(self.known) + len(often) > self.limit:
            self._forget()
        more, to_more = tx.gather(flat, to[:-1], np.diff(to), often)
        self.known = pa.concat_arrays([self.known, fresh.take(pa.array(often))])
        self.bounds = np.append(self.bounds, len(self.flat) + to_more[1:])
        self.flat = np.append(self.flat, more)
        return ids, ends[bounds]


def cut(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunks of marked texts begin, every first blank of a stretch, and the chunk bounds of the texts."""
    blank = data == 32
    head = blank.copy()
    head[1:] &= ~blank[:-1]
    head[off[:-1][np.diff(off) > 0]] = True
    starts = np.flatnonzero(head)
    return starts, np.searchsorted(starts, off)


def marked(texts: pa.Array) -> pa.Array:
    """Texts with the dummy prefix, a blank for every marker."""
    texts = pc.replace_substring(texts.fill_null(""), MARK, " ")
    return pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise("", texts, " "))


def encode(docs: DataFrame, path: str, slice_bytes: int = tx.SLICE_BYTES, known: int = KNOWN) -> DataFrame:
    """doc_id, ids (array of int) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tx.warm(("pieces", path, known), lambda: Table(path, known))
        texts = (pa.RecordBatch.from_arrays([b.column("doc_id"), marked(b.column("text"))], ["doc_id", "text"]) for b in batches)
        for rows, data, off in tx.slices(texts, slice_bytes):
            flat, bounds = table.encode(data, off)
            ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), ids], ["doc_id", "ids"])

    return tx.keyed(docs).mapInArrow(run, "doc_id long, ids array<int>")


class Decoder:
    def __init__(self, path: str):
        pieces = Pieces(path)
        strings = [b"" if i in pieces.control else p.replace(MARK, " ").encode() for i, p in enumerate(pieces.piece)]
        for b, i in pieces.byte.items():
            strings[i] = bytes([b])
        strings[pieces.unknown] = UNKNOWN
        self.marked = np.array([p.startswith(MARK) for p in pieces.piece])
        self.lens = np.array([len(s) for s in strings], np.int64)
        self.begin = np.cumsum(self.lens) - self.lens
        self.flat = np.frombuffer(b"".join(strings), np.uint8)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts of all documents' ids; the dummy prefix goes."""
        empty = self.lens[ids] == 0
        if empty.any():  # control ids
            bounds = bounds - np.append(0, np.cumsum(empty))[bounds]
            ids = ids[~empty]
        data, ends = tx.gather(self.flat, self.begin, self.lens, ids)
        ends = ends[bounds]
        begin = ends[:-1].copy()
        some = np.flatnonzero(np.diff(bounds))
        begin[some] += self.marked[ids[bounds[some]]]
        off = np.concatenate([[0], np.cumsum(ends[1:] - begin)])
        keep = np.ones(len(data), bool)
        keep[begin[begin > ends[:-1]] - 1] = False
        try:
            found = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data[keep]))])
            found.validate(full=True)
        except pa.ArrowInvalid:  # byte pieces that are no UTF-8
            found = pa.array([_text(data[a:b].tobytes()) for a, b in zip(begin, ends[1:], strict=True)], pa.large_string())
        return found.cast(pa.string())


def _text(data: bytes) -> str:
    """UTF-8 with one replacement character for each byte that belongs to no character."""
    out = []
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[: e.start].decode() + "�")
            data = data[e.start + 1 :]
    return "".join(out)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded: the text that the ids stand for; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = tx.warm(("decoder", path), lambda: Decoder(path))
        for rows in batches:
            ids = rows.column("ids")
            bounds = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy().astype(np.int64)))
            texts = decoder.decode(ids.flatten().to_numpy(zero_copy_only=False), bounds)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), ids, pc.if_else(ids.is_valid(), texts, None)], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
