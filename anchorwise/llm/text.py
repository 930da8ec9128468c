"""Vectorised text helpers shared by the operators: byte buffers, words, units, dictionary codes.

A slice of documents is one UTF-8 byte buffer with document offsets. Words and units are found with
numpy on the bytes, and Arrow's dictionary encoding turns them into integer codes, so per-string Python
work happens once per *distinct* string of a slice. Slices bound the memory; a text is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_WARM: dict[Hashable, object] = {}


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id and text, with further expressions, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def small_batches(spark, rows: int = 1000) -> None:
    """Arrow batches are sized by rows: fewer rows bound the bytes of a batch of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of whole documents, about ``limit`` bytes each; small batches are put together."""
    _only_this_stage()
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = raw(batch.column(column))[1]
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit - size, side="right")) - 1)
            hi = min(hi, batch.num_rows)
            held.append(batch.slice(lo, hi - lo))
            size += int(ends[hi] - ends[lo])
            lo = hi
            if size >= limit or lo < batch.num_rows:
                yield _joined(held, column)
                held, size = [], 0
    if held:
        yield _joined(held, column)
    released()


def released() -> None:
    """Gives unused memory back to the system at a task's end: workers live on beside those of the next stage."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def warm(key: Hashable, make: Callable[[], object]):
    """What a worker keeps between the tasks of a stage: a vocabulary and the words it met."""
    _only_this_stage()
    if key not in _WARM:
        _WARM[key] = make()
    return _WARM[key]


def _only_this_stage() -> None:
    """Drops what a worker kept for another stage, so operators that run one after the other don't add up."""
    task = TaskContext.get()
    stage = task.stageId() if task else None
    if _WARM.get("stage") != stage:
        _WARM.clear()
        released()
        _WARM["stage"] = stage


def _joined(held: list[pa.RecordBatch], column: str):
    table = pa.Table.from_batches(held).combine_chunks()
    rows = table.to_batches()[0]
    return (rows, *raw(rows.column(column)))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the n + 1 offsets; null counts as empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    texts = texts.cast(pa.large_string())
    _, off, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; all other bytes stay."""
    return _LOWER[data]


def words(data: np.ndarray, off: np.ndarray, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, or of runs of other bytes than ``outside``, and the word bounds of the documents."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    space = outside[data]
    before = np.empty(len(data), bool)
    before[1:] = space[:-1]
    before[off[:-1][off[:-1] < len(data)]] = True
    after = np.empty(len(data), bool)
    after[:-1] = space[1:]
    after[off[1:] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, off)


def codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Dictionary codes of the strings data[starts:ends] (in order, not overlapping) and the distinct strings."""
    found = coded(data, starts, ends)
    return found.indices.to_numpy().astype(np.int64), strings(found.dictionary)


def strings(texts: pa.Array) -> list[str]:
    """The strings of an array without nulls, made in one pass."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """The strings data[starts:ends] (in order, not overlapping), dictionary-encoded."""
    lens = ends - starts
    if int(lens.sum()) != len(data):
        mark = np.zeros(len(data) + 1, np.int8)
        mark[starts] += 1
        mark[ends] -= 1
        data = data[np.cumsum(mark[:-1], dtype=np.int8).view(bool)]
    off = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lens, out=off[1:])
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data)))
    return found.dictionary_encode()


def units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut points at which a byte-level BPE pattern always ends a match, so pieces encode independently.

    No alternative of the pattern runs from a non-space character into white space: a cut before a space or
    line feed that follows such a character is safe, and so is one after a single line feed between two such
    characters. Characters whose bytes could belong to Unicode white space are never used for a cut.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    blank, solid = joints(data)
    graph = (data > 32) & (data < 127)
    first = graph | ((data >= 0xC3) & (data <= 0xDF))  # the character that begins here is not white space
    cut = np.zeros(n + 1, bool)
    cut[1:n] = blank[1:] & solid[:-1]
    single = np.zeros(n, bool)
    single[1:-1] = (data[1:-1] == 10) & solid[:-2] & first[2:]
    cut[1:][single] = True
    cut[off] = True
    cut[n] = False
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    return starts, ends, np.searchsorted(starts, off)


def joints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a byte is a space or line feed, and whether it ends a character that is not white space: ASCII or U+00C0 to U+07FF.
    Between the second and the first a byte-level BPE pattern always ends a match."""
    solid = (data > 32) & (data < 127)
    solid[1:] |= (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    return (data == 32) | (data == 10), solid


def gather(flat: np.ndarray, begin: np.ndarray, lens: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenates flat[begin[k] : begin[k] + lens[k]] for k in picks; also the cumulated lengths."""
    n = lens[picks]
    ends = np.zeros(len(picks) + 1, np.int64)
    np.cumsum(n, out=ends[1:])
    kind = np.int32 if ends[-1] < 1 << 31 and len(flat) < 1 << 31 else np.int64
    at = np.arange(ends[-1], dtype=kind)
    at += np.repeat((begin[picks] - ends[:-1]).astype(kind), n)
    return flat[at], ends


def by_doc(bounds: np.ndarray) -> np.ndarray:
    """The document index of every word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def total(bounds: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Per-document sums of one value per word."""
    return np.bincount(by_doc(bounds), weights=values, minlength=len(bounds) - 1)


def letters(word: str) -> str:
    """The letters of a word in lower case."""
    return word.lower() if word.isalpha() else "".join(c for c in word if c.isalpha()).lower()
