"""Byte-level BPE ids from the tokenizers library, encoding every distinct unit of a worker's slices once."""

from __future__ import annotations

import os
from itertools import repeat

import numpy as np
import pyarrow as pa

from . import text as tx

CACHE = 800_000  # units that a worker remembers
CHUNK = 1 << 17  # bytes of units that go through the library as one text


class Units:
    """Encodes a slice: its distinct units go through the library, documents are put together from them.

    A call of the library costs more than the merges of a short unit. So units that can follow one another, which begin
    with a space or line feed and end in a character that is not white space, are encoded as one text: ``text.units`` would cut it
    at the same places. Each id stands for a known number of bytes, which tells where the units end among the ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocab = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of an id: a character of its string each
        self.width[list(vocab.values())] = list(map(len, vocab))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # a unit's number; its ids are flat[begin[k] : begin[k] + size[k]]
        self.flat, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all documents, and the n + 1 id bounds of the documents."""
        starts, ends, bounds = tx.units(data, off)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        found = tx.coded(data, starts, ends)
        distinct = tx.strings(found.dictionary)
        if len(self.known) > CACHE:
            self._forget()
        at = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        if len(new):
            flat, size = self._fresh(found.dictionary.take(pa.array(new)))
            at[new] = np.arange(len(self.size), len(self.size) + len(new))
            self.known.update(zip(map(distinct.__getitem__, new.tolist()), at[new].tolist(), strict=True))
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, flat])
        flat, to = tx.gather(self.flat, self.begin[at], self.size[at], found.indices.to_numpy().astype(np.int64))
        return flat, to[bounds]

    def _fresh(self, units: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and numbers of ids of units: those that can follow one another first as chunks, then each of the others."""
        data, off = tx.raw(units)
        blank, solid = tx.joints(data)
        joined = blank[off[:-1]] & solid[off[1:] - 1]
        ids, size = [], np.zeros(len(units), np.int64)
        together = np.flatnonzero(joined)
        text, to = tx.raw(units.take(pa.array(together)))
        lo = 0
        while lo < len(together):
            hi = max(lo + 1, int(np.searchsorted(to, to[lo] + CHUNK, side="right")) - 1)
            hi = min(hi, len(together))
            got = self._ids([text[to[lo] : to[hi]].tobytes().decode()])[0]
            ends = np.append(0, np.cumsum(self.width[got]))
            cuts = np.searchsorted(ends, to[lo : hi + 1] - to[lo])
            if not np.array_equal(ends[cuts], to[lo : hi + 1] - to[lo]):
                raise ValueError("an id reaches over the end of a unit")
            ids.append(got)
            size[together[lo:hi]] = np.diff(cuts)
            lo = hi
        alone = np.flatnonzero(~joined)
        for got in self._ids(tx.strings(units.take(pa.array(alone)))):
            ids.append(got)
        size[alone] = list(map(len, ids[len(ids) - len(alone) :])) if len(alone) else 0
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        order = np.concatenate([together, alone])  # the ids lie in this order
        begin = np.empty(len(units), np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        return tx.gather(flat, begin, size, np.arange(len(units)))[0], size

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for lo in range(0, len(texts), 5000):
            got = self.tokenizer.encode_batch_fast(texts[lo : lo + 5000], add_special_tokens=False)
            out += [np.array(g.ids, np.uint32) for g in got]
        return out


def loaded(path: str) -> Units:
    """A worker's encoder."""
    return tx.warm(("units", path), lambda: Units(path))


def ended(flat: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each document."""
    return np.insert(flat, bounds[1:], end), bounds + np.arange(len(bounds))
