"""Source divergences from in-mapper stripes against SQL and brute force in Python's integers."""

import re
from collections import Counter, defaultdict

import pytest

from anchorwise.llm import divergence, queries
from tests.oracle_compare import rows as sorted_rows
from tests.oracle_compare import type_diffs

from .conftest import SCHEMA, table

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, least=10):
    df, counts, sources = Counter(), Counter(), defaultdict(set)
    for text, lang, source in ((t or "", g or "", s or "") for t, g, s in docs):
        terms = [m.translate(LOWER) for m in TERM.findall(text)]
        sources[lang].add(source)
        df.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    out = []
    for lang, names in sources.items():
        kept = sorted(t for (g, t), n in df.items() if g == lang and n >= least)
        v = len(kept)
        rows = {s: [counts[lang, s, t] for t in kept] for s in names}
        whole = [sum(rows[s][k] for s in names) for k in range(v)]
        share = lambda c, total: 1 + 10**9 * (c + 2) // (total + 2 * v)
        p = {s: [share(c, sum(r)) for c in r] for s, r in rows.items()}
        q = [share(c, sum(whole)) for c in whole]
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in names:
            pair = [(-sum(map(gap, p[s], p[o])), o.encode()) for o in names if o != s]
            term = [(-gap(p[s][k], q[k]), kept[k].encode()) for k in range(v) if rows[s][k] and p[s][k] > q[k]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:10])):
                out += [(lang, s, part, i.decode(), -value, k) for k, (value, i) in enumerate(found, 1)]
    return sorted(out)


def test_audit_is_brute_force(spark, folder):
    got = sorted(map(tuple, queries.op13_divergence(spark, folder).collect()))
    assert got == brute(table(spark, folder, ("text", "lang", "source")))
    assert {r[2] for r in got} == {"pair", "term"} or folder != "/root/testdata/sf0.001"


def test_small_spills_buckets_and_blocks(spark, folder, monkeypatch):
    """Many spills of one stripe, languages over many buckets, and more sources than a block holds."""
    docs = queries.documents(spark, folder)
    stripes = divergence.merged_stripes
    monkeypatch.setattr(divergence, "merged_stripes", lambda d, least: stripes(d, least, limit=300, slice_bytes=20_000))
    for least in (1, 3):
        got = divergence.audit(docs, least, bucket_terms=50, width=3)
        assert sorted(map(tuple, got.collect())) == brute(table(spark, folder, ("text", "lang", "source")), least)


def test_audit_is_its_sql(spark, duck0001):
    got, sql = queries.op13_divergence(spark, "/root/testdata/sf0.001"), queries.oracles()["op13_divergence"]
    assert not type_diffs(got, sql, duck0001)
    assert sorted_rows(got.toPandas()) == sorted_rows(duck0001.sql(sql).df())


def test_empty_table_and_sources_without_terms(spark, empty):
    assert queries.op13_divergence(spark, empty).collect() == []
    docs = spark.createDataFrame([(1, "", "aa", "s"), (2, None, "aa", "t"), (3, "12 --", "aa", None), (4, "x y", None, "u")], SCHEMA.fieldNames()[:4])
    assert sorted(map(tuple, divergence.audit(docs).collect())) == brute([("", "aa", "s"), (None, "aa", "t"), ("12 --", "aa", None), ("x y", None, "u")])


@pytest.mark.parametrize("count, whole", [(0, 2), (5, 7), (10**12, 3 * 10**12 + 1), (8 * 10**15, 8 * 10**15 + 5)])
def test_shares_are_exact_beyond_64_bits(count, whole):
    import numpy as np

    assert int(divergence.shares(np.array([count], np.int64), np.array([whole], np.int64))[0]) == 1 + 10**9 * (count + 2) // whole
