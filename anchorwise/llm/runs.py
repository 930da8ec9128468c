"""Periodic runs of words, found by Baier grouping.

A run is a maximal stretch of a text's words with smallest period q whose length reaches ``exponent`` times q and
``least`` words. By the runs theorem each run holds Lyndon roots of length q under the order of the words or under its
reverse, and each such root is the longest Lyndon word that begins at its place. Phase one of Baier's suffix sorter
gives the length of the longest Lyndon word at every place directly: suffixes lie in groups of equal Lyndon prefixes, the
groups are taken from the highest down, and the nearest place to the left in a lower group takes the prefix of the group
onto its own, once for each suffix that points to it. It runs under both orders. Roots that stand ``exponent`` - 1 times
in a row are extended to both sides by their longest common extensions with the place one period on.

A word that a text holds fewer than ``exponent`` times lies in no run. Such words become stops, lower than any word
under both orders; so do the ends of texts, and a slice of texts is grouped in one go. Words are ordered by their
dictionary codes: any order will do, and its reverse.

Spark deals documents to tasks in slices of ``SLICE`` bytes of whole texts; nothing is shuffled. A text longer than a
slice makes one of its own, and takes about 30 bytes of memory for each of its bytes.

Null, empty and blank texts have no words, no runs and an empty collapsed text. Rows, also repeated ones and those without
an id, are kept one for one; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as tx

SLICE = 2 << 20
LEAST, EXPONENT = 6, 4
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_lengths(codes: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at every place; codes[0] is a stop (0), and no Lyndon word passes a stop."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    new = np.flatnonzero(np.diff(codes[order])) + 1
    bounds = [0, *new.tolist(), n]
    rank = np.zeros(n, np.int64)
    rank[new] = 1
    at = np.empty(n, np.int64)
    at[order] = np.cumsum(rank)
    group, order = at.tolist(), order.tolist()
    members = [order[a:b] for a, b in zip(bounds, bounds[1:], strict=False)] + [[]]
    top = len(members) - 1  # an empty group above all others
    size, length = [len(m) for m in members], [1] * (top + 1)
    below, above = list(range(-1, top)), list(range(1, top + 2))
    left, right = list(range(-1, n)), list(range(1, n + 2))  # the places that no taken group holds

    def raised(old: int, places: list[int], more: int) -> int:
        """A new group right above ``old``."""
        new, over = len(members), above[old]
        members.append(places)
        size.append(len(places))
        length.append(length[old] + more)
        below.append(old)
        above.append(over)
        above[old] = below[over] = new
        return new

    g = below[top]
    while g:
        c = length[g]
        live = [i for i in members[g] if group[i] == g]
        if len(live) == 1:
            i = live[0]
            a, b = left[i], right[i]
            left[b], right[a] = a, b
            o = group[a]
            if o:
                if size[o] == 1:
                    length[o] += c
                else:
                    size[o] -= 1
                    group[a] = raised(o, [a], c)
        elif live:
            places, times, last, most = [], [], -1, 1
            for i in live:  # in ascending order, so left[i] is never in this group
                a, b = left[i], right[i]
                left[b], right[a] = a, b
                if a == last:
                    times[-1] += 1
                    most = max(most, times[-1])
                elif group[a]:
                    places.append(a)
                    times.append(1)
                    last = a
            for t in range(most, 0, -1):
                made: dict[int, int] = {}
                for a, m in zip(places, times, strict=True):
                    if m != t:
                        continue
                    o = group[a]
                    size[o] -= 1
                    if o in made:
                        group[a] = made[o]
                        members[made[o]].append(a)
                        size[made[o]] += 1
                    else:
                        group[a] = made[o] = raised(o, [a], c * t)
        g = below[g]
    return np.array(length, np.int64)[np.array(group, np.int64)]


def _common(words: np.ndarray, i: int, j: int) -> int:
    """Length of the longest common prefix of words[i:] and words[j:], i < j."""
    done, step = 0, 32
    while j + done < len(words):
        b = words[j + done : j + done + step]
        differ = np.flatnonzero(words[i + done : i + done + len(b)] != b)
        if len(differ):
            return done + int(differ[0])
        done += len(b)
        step *= 4
    return done


def runs(codes: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, ascending. Codes are positive; 0 is a stop, as codes[0] and codes[-1] are."""
    words = codes.copy()
    stops = np.flatnonzero(codes == 0)
    words[stops] = -np.arange(1, len(stops) + 1)  # no two stops are equal
    back, n = words[::-1], len(words)
    found: set[tuple[int, int, int]] = set()
    highest = codes.max(initial=0)
    for order in (codes, np.where(codes > 0, highest + 1 - codes, 0)):
        period = lyndon_lengths(order)
        period[stops] = 0
        place = np.flatnonzero(period)
        for k in range(1, exponent - 1):  # the roots that follow: the same word, the same length
            p = period[place]
            place, p = (x[place + k * p < n] for x in (place, p))
            ahead = place + k * p
            place = place[(period[ahead] == p) & (words[ahead] == words[place])]
        end_of: dict[int, int] = {}
        for i, p in zip(place.tolist(), period[place].tolist(), strict=True):
            if i + p <= end_of.get(p, 0):
                continue  # a root of the run found before
            end = i + p + _common(words, i, i + p)
            start = i - _common(back, n - i - p, n - i)
            if end - start >= max(least, exponent * p):
                end_of[p] = end
                found.add((start, end - start, p))
    return sorted(found)


def _sequence(picks: np.ndarray, bounds: np.ndarray, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts' words with a stop before each text and after the last; places of the stops before the texts."""
    n, docs = len(picks), len(bounds) - 1
    doc = tx.by_doc(bounds)
    _, of, times = np.unique(doc * (int(picks.max(initial=0)) + 1) + picks, return_inverse=True, return_counts=True)
    frequent = times[of] >= exponent
    edge = np.flatnonzero(np.diff(frequent, prepend=False, append=False) | np.isin(np.arange(n + 1), bounds)) if n else np.zeros(0, np.int64)
    short = np.diff(edge, append=n) < least  # no run fits between two stops so near
    frequent[np.repeat(short, np.diff(edge, append=n))] = False
    out = np.zeros(n + docs + 1, np.int64)
    out[np.arange(n) + doc + 1] = np.where(frequent, picks + 1, 0)
    return out, bounds[:-1] + np.arange(docs)


def find(data: np.ndarray, off: np.ndarray, least: int, exponent: int):
    """Per text: number of words, runs (start, length, period), collapsed text; as Arrow arrays."""
    starts, ends, bounds = tx.words(data, off)
    picks = tx.coded(data, starts, ends).indices.to_numpy().astype(np.int64)
    codes, heads = _sequence(picks, bounds, least, exponent)
    docs = len(off) - 1
    got = np.array(runs(codes, least, exponent), np.int64).reshape(-1, 3)
    doc = np.searchsorted(heads, got[:, 0], side="right") - 1
    first = got[:, 0] - heads[doc] - 1
    kept = np.zeros(len(starts) + 1, np.int64)  # times dropped, by differences
    np.add.at(kept, bounds[doc] + first + got[:, 2], 1)
    np.add.at(kept, bounds[doc] + first + got[:, 1], -1)
    kept = np.cumsum(kept[:-1]) == 0
    per_doc = np.zeros(docs + 1, np.int64)
    np.cumsum(np.bincount(doc, minlength=docs)[:docs], out=per_doc[1:])
    order = np.lexsort((got[:, 2], first, doc))
    run = pa.StructArray.from_arrays([pa.array(x[order]) for x in (first, got[:, 1], got[:, 2])], fields=list(_RUN))
    listed = pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), run)
    return pa.array(np.diff(bounds)), listed, _joined(data, starts[kept], ends[kept], np.searchsorted(np.flatnonzero(kept), bounds))


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The words of each text, joined by one space."""
    last = np.zeros(len(starts), bool)
    last[bounds[1:][np.diff(bounds) > 0] - 1] = True
    mark = np.zeros(len(data) + 2, np.int8)
    mark[starts] += 1
    np.add.at(mark, ends + ~last, -1)  # the byte after a word that is not its text's last is white space
    keep = np.cumsum(mark[:-2], dtype=np.int8).view(bool)
    out = data.copy()
    out[ends[~last]] = 32
    size = np.concatenate([[0], np.cumsum(ends - starts + ~last)])[bounds]
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(out[keep]))).cast(pa.string())


def periodic_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by word number; by start, then period) and collapsed: the text's words, joined by one space, without those that a run holds after its first period."""
    if exponent < 2 or least < 2:
        raise ValueError("a run holds its period twice at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in tx.slices(batches, SLICE):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *find(data, off, least, exponent)], ["doc_id", "n_words", "runs", "collapsed"])

    return tx.keyed(docs).mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
