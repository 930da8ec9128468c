"""Packing token sequences by best-fit decreasing.

A document longer than the window is first cut into full windows, each of which fills a sequence; what is left,
less than a window, is packed. Pieces are dealt to tasks by a hash of all their columns, so neither the windows of one long document
nor rows that share an id meet in one task, and sorted there by falling length; each
goes into the open window with the least room that still takes it. A segment tree over the remaining capacities
finds it: a leaf holds the open windows with that much room, an inner node whether any leaf below has one. A task
keeps the windows' numbers and fill levels only; the rows stream through.

Texts are encoded once and pieces shuffled once. A sequence's number is the task's in the high bits and a count
within the task in the low ones.

Null texts count as empty: one piece with the end id alone. Rows are kept one for one, repeated ones too; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .tokens import ended, loaded

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


class Windows:
    """Open windows by remaining capacity."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.size = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = 0

    def _mark(self, room: int) -> None:
        i = room + self.size
        self.any[i] = bool(self.open[room])
        while i > 1:
            i >>= 1
            now = self.any[2 * i] | self.any[2 * i + 1]
            if self.any[i] == now:
                break
            self.any[i] = now

    def _tightest(self, length: int) -> int:
        """The least room >= length that a window has, or -1."""
        i = length + self.size
        if self.any[i]:
            return length
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1

    def place(self, length: int) -> tuple[int, int]:
        """Window and offset of a piece."""
        room = self._tightest(length)
        if room < 0:
            window, room = self.count, self.capacity
            self.count += 1
        else:
            window = self.open[room].pop()
            if not self.open[room]:
                self._mark(room)
        left = room - length
        if left:
            self.open[left].append(window)
            if len(self.open[left]) == 1:
                self._mark(left)
        return window, self.capacity - room


def pieces(docs: DataFrame, vocabulary: str, end: int, capacity: int) -> DataFrame:
    """Every document's ids, with ``end`` after them, cut into full windows and a tail: doc_id, start, length, doc_tokens, ids.

    ids are little-endian unsigned integers of 32 bits, in a binary column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = loaded(vocabulary)
        for rows, data, off in tx.slices(batches, tx.SLICE_BYTES // 2):
            flat, bounds = ended(*units.encode(data, off), end)
            n = np.diff(bounds)
            parts = -(-n // capacity)
            of = np.repeat(np.arange(len(n)), parts)
            start = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * capacity
            length = np.minimum(n[of] - start, capacity)
            to = np.concatenate([[0], np.cumsum(length)])  # pieces cover the flat ids in order
            ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(of), [None, pa.py_buffer(4 * to), pa.py_buffer(flat.astype("<u4").tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").take(pa.array(of)), pa.array(start), pa.array(length), pa.array(n[of]), ids], ["doc_id", "start", "length", "doc_tokens", "ids"])

    tx.small_batches(docs.sparkSession)
    return tx.keyed(docs).mapInArrow(run, PIECES)


def pack(cut: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to pieces of at most ``capacity`` tokens; columns other than length pass through."""
    keys = [F.col(f"`{c}`") for c in cut.columns]
    dealt = cut.repartition(*keys).sortWithinPartitions(F.desc("length"), *keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, base = Windows(capacity), TaskContext.get().partitionId() << 33
        for rows in batches:
            put = np.array([windows.place(n) for n in rows.column("length").to_pylist()], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(base + put[:, 0]), pa.array(put[:, 1])], [*rows.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in cut.dtypes)
    return dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")
