"""Quality rules by compression bands.

A text's zstandard ratio (bytes by compressed bytes) is held against limits for its length: above the upper limit
it repeats itself, below the lower one it is noise. The whole document has one band by its byte length; a document
of one chunk or more is also cut into fixed chunks, which share one band, and is rejected when more than
``BAD_SHARE`` of its chunks fall outside. All chunks are of equal size: the last one ends with the text and may reach
into the one before. Short texts compress little whatever they say, so their limits are wide.

The upper limits are 1.5 times the greatest ratio, by length band, of texts labelled quality 1 (sf0.1: 1.74, 1.97, 2.22, 2.41 and
2.48, chunks 2.26; no labelled text is longer, so the last band follows the trend).

The chunk band's lower limit lies above encoded random bytes (base85 1.22, base64 1.31, base62 1.32 at level 3) and below the chunks of the
given prose (2.07 at least on sf0.1). Random base32 (1.57) and hexadecimal (1.9) text compresses like dense prose and is not told
from it, nor is noise dealt among prose line by line whose ratio together reaches the limits.

Null texts have no word. Rows are kept one for one; a row whose text is empty fails the base rules; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as tx

LEVEL = 3
CHUNK = 4096
#: Up to so many bytes: least and greatest ratio.
BANDS = ((256, 0.50, 2.6), (1024, 1.15, 2.9), (4096, 1.35, 3.3), (16384, 1.45, 3.6), (65536, 1.50, 3.7), (1 << 62, 1.50, 4.0))
CHUNK_BAND = (1.40, 3.4)
BAD_SHARE = 0.2
MIN_WORDS, REPEAT_PERCENT = 50, 50
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long, verdict string"


def band(size: int) -> tuple[float, float]:
    return next((lo, hi) for top, lo, hi in BANDS if size <= top)


def verdict(data: bytes, compress) -> tuple[float, int, int, str]:
    """Ratio of the whole text, its chunks, those outside their band, and what is wrong ('' if nothing is)."""
    if not data:
        return 1.0, 0, 0, ""
    ratio = len(data) / len(compress(data))
    lo, hi = band(len(data))
    said = "repetitive" if ratio > hi else "incompressible" if ratio < lo else ""
    chunks = -(-len(data) // CHUNK) if len(data) >= CHUNK else 0
    bad = 0
    for i in range(chunks):
        at = min(i * CHUNK, len(data) - CHUNK)
        r = CHUNK / len(compress(data[at : at + CHUNK]))
        bad += not CHUNK_BAND[0] <= r <= CHUNK_BAND[1]
    if not said and bad > BAD_SHARE * chunks:
        said = "chunks"
    return ratio, chunks, bad, said


def repeat_words(codes: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(codes)
    if n < 4:
        return 0
    a = codes - codes.min()
    top = int(a.max()) + 1
    if top >= 1 << 21:  # small numbers again, so that three fit in 63 bits
        a = np.unique(a, return_inverse=True)[1]
        top = int(a.max()) + 1
    if top < 1 << 21:
        key = (a[:-2] * top + a[1:-1]) * top + a[2:]
    else:
        pair = np.unique(a[:-1] * top + a[1:], return_inverse=True)[1]
        key = np.unique(np.stack([pair[:-1], a[2:]]), axis=1, return_inverse=True)[1].ravel()
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(n, bool)
    inside[:-2] |= twice
    inside[1:-1] |= twice
    inside[2:] |= twice
    return int(np.count_nonzero(inside))


def dup_lines(text: str) -> int:
    r"""\n-split lines with a word that equal an earlier line."""
    seen: set[str] = set()
    found = 0
    for line in text.split("\n"):
        if line in seen:
            found += bool(line.strip(" \t\n\v\f\r"))
        else:
            seen.add(line)
    return found


def quality(docs: DataFrame) -> DataFrame:
    """Counts, base rules, compression ratios and verdict of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for rows, data, off in tx.slices(batches):
            starts, ends, bounds = tx.words(data, off)
            codes, _ = tx.codes(data, starts, ends)
            lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points begin at these bytes
            symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
            n_words = np.diff(bounds)
            chars = tx.total(bounds, lead[ends] - lead[starts]).astype(np.int64)
            n_symbols = symbols[off[1:]] - symbols[off[:-1]]
            buffer = data.tobytes()
            repeats, lines, checks = [], [], []
            for d in range(rows.num_rows):
                text = buffer[off[d] : off[d + 1]]
                repeats.append(repeat_words(codes[bounds[d] : bounds[d + 1]]))
                lines.append(dup_lines(text.decode()))
                checks.append(verdict(text, compress))
            repeats = np.array(repeats, np.int64)
            failed = (n_words < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * n_words)
            ratio, chunks, bad, said = zip(*checks, strict=True)
            kept = ~failed & np.array([not s for s in said])
            columns = [rows.column("doc_id"), *map(pa.array, (n_words, chars, n_symbols, np.array(lines, np.int64), repeats, failed, kept)), pa.array(ratio, pa.float64()), pa.array(chunks, pa.int64()), pa.array(bad, pa.int64()), pa.array(said, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])

    tx.small_batches(docs.sparkSession)
    return tx.keyed(docs).mapInArrow(run, SCHEMA)
