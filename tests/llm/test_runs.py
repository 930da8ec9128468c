"""Runs of words by Baier grouping against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from anchorwise.llm import queries, runs, text

from .conftest import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=6, exponent=4):
    """All runs, period by period; the smallest period of a stretch of twice its length divides every other such."""
    code = {w: k for k, w in enumerate(dict.fromkeys(words))}
    a = np.array([code[w] for w in words], np.int64)
    out = []
    for p in range(1, len(a) // exponent + 1):
        same = np.concatenate([[0], (a[p:] == a[:-p]).astype(np.int8), [0]])
        for start, end in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1) + p, strict=True):
            if end - start >= max(least, exponent * p) and not any(p % q == 0 and np.array_equal(a[start + q : end], a[start : end - q]) for q in range(1, p)):
                out.append((int(start), int(end - start), p))
    return sorted(out)


def planted(doc_id, words):
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def answer(doc_id, t):
    words = planted(doc_id, WORD.findall(t or ""))
    found = brute(words)
    drop = {k for s, n, p in found for k in range(s + p, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(found), *top, sha("".join(f"{s},{n},{p}\n" for s, n, p in found)), sha(" ".join(w for k, w in enumerate(words) if k not in drop))


def test_runs_are_those_of_brute_force(spark, folder):
    got = Counter(map(tuple, queries.op11_runs(spark, folder).collect()))
    assert got == Counter(answer(i, t) for i, t in table(spark, folder))
    assert any(k[1] for k in got)


def test_empty_table_has_no_runs(spark, empty):
    assert queries.op11_runs(spark, empty).collect() == []


def longest_lyndon(s, i):
    return max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j)))


def test_phase_one_gives_the_longest_lyndon_words():
    rnd = random.Random(3)
    for _ in range(300):
        parts = [[rnd.randint(1, 3) for _ in range(rnd.randint(0, 12))] for _ in range(3)]
        sequence = [0] + [x for p in parts for x in [*p, 0]]
        want = [n for p in parts for n in [1, *(longest_lyndon(p, i) for i in range(len(p)))]]
        got = runs.lyndon_lengths(np.array(sequence))
        assert [int(g) for g, c in zip(got, sequence, strict=True) if c] == [n for n, c in zip([*want, 1], sequence, strict=True) if c]


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (4, 3), (9, 2)])
def test_runs_of_other_limits(least, exponent):
    rnd = random.Random(least * 10 + exponent)
    docs = []
    for _ in range(150):
        words = []
        for _ in range(rnd.randint(0, 5)):
            words += [rnd.choice("abc") for _ in range(rnd.randint(1, 4))] * rnd.randint(1, 6) + [rnd.choice("abcd") for _ in range(rnd.randint(0, 3))]
        docs.append(words)
    data, off = text.raw(pa.array([" ".join(d) for d in docs]))
    n, found, _ = runs.find(data, off, least, exponent)
    assert n.to_pylist() == [len(d) for d in docs]
    assert [[tuple(r.values()) for r in f] for f in found.to_pylist()] == [brute(d, least, exponent) for d in docs]
