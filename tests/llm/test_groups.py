"""Exact and near duplicates, components, the language model and the pipeline, against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from anchorwise.llm import components, dedup, katz, queries, simhash, text

from .conftest import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """doc_id, fingerprint, least doc_id that is reachable."""
    prints = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for k, f in enumerate(distinct):
        for g in distinct[:k]:
            if (f ^ g).bit_count() <= 3:
                parent[root(f)] = root(g)
    least = {}
    for (i, _), f in zip(rows, prints, strict=True):
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return Counter((i, f"{f:016x}", least.get(root(f))) for (i, _), f in zip(rows, prints, strict=True))


def test_simhash(spark, folder, monkeypatch):
    rows = table(spark, folder)
    want = brute_components(rows)
    assert Counter(map(tuple, queries.op7_simhash(spark, folder).collect())) == want
    monkeypatch.setattr(simhash, "TILE_LEAST", 16)
    assert Counter(map(tuple, queries.op7_simhash(spark, folder).collect())) == want


@pytest.mark.parametrize("dense", [False, True])
def test_forest_links_what_brute_force_links(dense):
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 1 << 63, 40, dtype=np.uint64)
    x = []
    for b in base:
        for _ in range(60 if dense else 8):
            x.append(int(b))
            for _ in range(int(rnd.integers(1, 3))):
                b = b ^ (np.uint64(1) << np.uint64(rnd.integers(0, 64 if not dense else 6)))
    x = np.unique(np.array(x, np.uint64))
    a, b = x[::2], x[1::2]
    for left, right in ((x, None), (a, b)):
        both = x if right is None else np.concatenate([a, b])
        labels = []
        for edges in (simhash.forest(left, right), [(i, j) for i in range(len(both)) for j in range(len(both)) if (right is None and i < j or right is not None and i < len(a) <= j) and int(both[i] ^ both[j]).bit_count() <= 3]):
            parent = list(range(len(both)))
            for i, j in edges:
                assert int(both[i] ^ both[j]).bit_count() <= 3
                parent[simhash._root(parent, j)] = simhash._root(parent, i)
            found = [simhash._root(parent, i) for i in range(len(both))]
            labels.append([found.index(f) for f in found])
        assert labels[0] == labels[1]
        assert len(simhash.forest(left, right)) < len(both)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(2000, 2300)] + [(5, 5), (7, 8)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(61)}, **{k: 1000 for k in (1000, *range(2000, 2300))}}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    ids = defaultdict(list)
    for (i, _), n in zip(rows, norm, strict=True):
        ids[n].append(i)
    least = {n: min((i for i in v if i is not None), default=None) for n, v in ids.items()}
    import hashlib

    left = dict.fromkeys(ids, True)  # one row of the smallest id stays, however many rows have it
    out = Counter()
    for (i, _), n in zip(rows, norm, strict=True):
        kept = i == least[n] and left[n]
        left[n] = left[n] and not kept
        out[i, least[n], len(ids[n]), kept, hashlib.sha256(n.encode()).hexdigest()] += 1
    return out


def test_exact_dedup(spark, folder, monkeypatch):
    want = exact(table(spark, folder))
    assert Counter(map(tuple, queries.op9_exact_dedup(spark, folder).collect())) == want
    docs = queries.documents(spark, folder)
    few_bits = dedup.annotate(docs, ["doc_id"], bits=6)  # most fingerprints collide: the bytes decide
    assert Counter(tuple(r)[1:] for r in few_bits.collect()) == want


def test_exact_dedup_without_broadcast(spark, edge, monkeypatch):
    from anchorwise.llm import shared

    monkeypatch.setattr(shared, "BROADCAST_ROWS", -1)
    assert Counter(map(tuple, queries.op9_exact_dedup(spark, edge).collect())) == exact(table(spark, edge))
    kept = dedup.deduplicate(queries.documents(spark, edge))
    assert kept.columns == queries.documents(spark, edge).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({k[0]: n for k, n in exact(table(spark, edge)).items() if k[3]})


def test_exact_dedup_oracle(spark, edge):
    sql = queries.oracles()["op9_exact_dedup"]
    for path, rows in (("/root/testdata/sf0.001/documents.parquet", table(spark, "/root/testdata/sf0.001")), (f"{edge}/documents.parquet/*.parquet", table(spark, edge))):
        assert Counter(duckdb.sql(sql.replace("FROM documents", f"FROM '{path}'")).fetchall()) == exact(rows)


def test_one_row_of_a_group_stays(spark):
    """Rows that repeat an id, or have none: one of equal texts, and one of each component of near copies."""
    words = [f"w{k}" for k in range(300)]
    long, near = " ".join(words), " ".join([*words[:150], "zz", *words[151:]])
    rows = [(None, "a b"), (None, "a  b"), (5, "x"), (5, "x"), (5, "y y y"), (3, long), (7, near), (7, "q r s"), (None, long), (9, "q r  s"), (None, "n n n"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, dedup.annotate(docs, ["doc_id"]).drop("row").collect())) == exact(rows)
    kept = [re.sub(" +", " ", t or "") for _, t in dedup.deduplicate(docs).collect()]
    assert sorted(kept) == sorted({re.sub(" +", " ", t or "") for _, t in rows})
    left = Counter((i, re.sub(" +", " ", t or "")) for i, t in simhash.deduplicate(docs).collect())
    assert (3, long) in left and left[5, "x"] == 1 and left[5, "y y y"] == 1 and not any(t == near for _, t in left)
    assert sum(n for (_, t), n in left.items() if t == "q r s") == 1 and sum(n for (_, t), n in left.items() if t == "a b") == 1
    assert sum(n for (_, t), n in left.items() if t == "") == 1


@pytest.mark.parametrize("bits", [3, 12, 30, 64])
def test_quotient_filters_merge_without_loss(spark, bits):
    rnd = np.random.default_rng(bits)
    fps = rnd.integers(0, 1 << min(bits, 62), 3000)
    fps = np.concatenate([fps, fps[:500], fps[:100]])
    want = {int(f): n for f, n in Counter(fps.tolist()).items() if n > 1}
    df = spark.createDataFrame([(int(f),) for f in fps], "fp long").repartition(5)
    assert dict(map(tuple, dedup.duplicate_fingerprints(df, bits).collect())) == want


def katz_brute(rows):
    """Scores by the recursion, token by token."""
    docs = [(i, [*WORD.findall((t or "").translate(LOWER)), ""], zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1) for i, t in rows]
    words, pairs = Counter(), Counter()
    for _, tokens, train in docs:
        if train:
            words.update(tokens)
            pairs.update(zip(["", *tokens[:-1]], tokens, strict=True))
    n, types = sum(words.values()), len(words)
    of = lambda c: [sum(v == r for v in c.values()) for r in range(1, katz.K + 2)]
    dw, dp = katz.discounts(of(words)), katz.discounts(of(pairs))
    d = lambda t, c: t[c] if c <= katz.K else 1.0
    known = {w: d(dw, c) * c / n for w, c in words.items()}
    unknown = 1 - sum(known.values())
    assert unknown > 0
    context, left, seen = Counter(), defaultdict(float), defaultdict(float)
    for (v, w), c in pairs.items():
        context[v] += c
        left[v] += c * (1 - d(dp, c))
        seen[v] += known[w]

    def p(v, w):
        if v not in context:
            return known.get(w, unknown)
        total = context[v] if left[v] > 0 else context[v] + 1
        if (v, w) in pairs:
            return d(dp, pairs[v, w]) * pairs[v, w] / total
        return (left[v] or 1) / total / (1 - seen[v]) * known.get(w, unknown)

    for v in ["", *list(context)[:20]]:  # each distribution sums to one
        assert math.isclose(sum(p(v, w) for w in words) + p(v, object()), 1, rel_tol=1e-9)
    out = []
    for i, tokens, train in docs:
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (types + 1))) for w in tokens)
        out.append((i, not train, len(tokens), sum(w in words for w in tokens), n, base, sum(math.log10(p(v, w)) for v, w in zip(["", *tokens[:-1]], tokens, strict=True))))
    return out


@pytest.mark.parametrize("hot", [None, 40])
def test_katz(spark, folder, hot, monkeypatch):
    if hot:  # contexts dealt over several buckets
        send, merge = katz._send_pairs, katz._merge
        monkeypatch.setattr(katz, "_send_pairs", lambda b, _: send(b, hot))
        monkeypatch.setattr(katz, "_merge", lambda b, _: merge(b, hot))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    want = sorted(katz_brute(table(spark, folder)), key=key)
    got = sorted(map(tuple, queries.op8_katz(spark, folder).collect()), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


#: Words and pairs seen 1 to 6 times in the training rows of sf0.01 and sf0.1, counted apart from the operator.
@pytest.mark.parametrize("n", [[47735, 12166, 4990, 2407, 2203, 1012], [184712, 23127, 5984, 1951, 2262, 607], [200420, 57120, 23804, 13644, 12859, 6775], [1482341, 227973, 46941, 19718, 17404, 6993]])
def test_discounts_are_good_turings(n):
    x, y = [math.log(r) for r in range(1, 7)], [math.log(v) for v in n]
    mx, my = sum(x) / 6, sum(y) / 6
    slope = sum((a - mx) * (b - my) for a, b in zip(x, y, strict=True)) / sum((a - mx) ** 2 for a in x)
    fit = [math.exp(my + slope * (a - mx)) for a in x]
    common = 6 * fit[5] / fit[0]
    want = [((r + 1) * fit[r] / (r * fit[r - 1]) - common) / (1 - common) for r in range(1, 6)]
    got = katz.discounts(n)
    assert got[0] == 0 and np.allclose(got[1:], want) and all(0 < d < 1 for d in want) and want == sorted(want)


@pytest.mark.parametrize("n", [[0] * 6, [3, 0, 0, 0, 0, 0], [0, 5, 0, 0, 0, 0], [1, 2, 3, 4, 5, 6], [9, 0, 0, 0, 4, 0]])
def test_discounts_of_thin_counts(n):
    got = katz.discounts(n)[1:]
    assert all(0 < d < 1 for d in got) and list(got) == sorted(got)


def test_katz_deals_rows_of_one_id_over_the_chunks(spark):
    docs = [(None, f"text {k}") for k in range(300)] + [(None, None)] * 300 + [(7, "the same row")] * 300
    rows = text.keyed(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), (text.remainder() != 1).alias("train"))
    sizes = Counter()
    for r in katz.deal(rows, 10).collect():
        sizes[r["chunk"]] += len(r["doc_ids"])
    assert sum(sizes.values()) == 900 and len(sizes) == 10 and max(sizes.values()) < 150
    got = katz.fit_and_score(rows.select("doc_id", "text"), text.remainder() != 1).collect()
    assert Counter(r["doc_id"] for r in got) == {None: 600, 7: 300} and len({r["score"] for r in got if r["doc_id"] == 7}) == 1


def test_katz_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = katz.fit_and_score(docs, text.remainder() > 9).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in sorted(got)] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]


def test_no_rows(spark, empty):
    for q in (queries.op7_simhash, queries.op8_katz, queries.op9_exact_dedup):
        assert q(spark, empty).collect() == []


def test_pipeline(spark, folder):
    docs = queries.documents(spark, folder)
    rows = table(spark, folder)
    language = corpus_pipeline.language(spark, docs, folder)
    assert language.columns == docs.columns
    kept = {r["doc_id"] for r in language.collect()}
    assert kept <= {i for i, t in rows if any(c.isalpha() for c in t or "")}
    if folder.endswith("sf0.001"):
        assert len(kept) == len(rows)
    rest = [r for r in rows if r[0] in kept]
    first = {k[0] for k in exact(rest) if k[3]}
    rest = [r for r in rest if r[0] in first]
    least = {k[0] for k in brute_components(rest) if k[0] is None or k[0] == k[2]}
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in got} == least
    ends = {r["doc_id"]: r["doc_tokens"] for r in got}
    assert sum(r["length"] for r in got if r["doc_id"] is not None) >= sum(n for i, n in ends.items() if i is not None)


def test_pipeline_of_no_rows(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []
