"""BPE replay, wavelet shards and packing against the tokenizer libraries."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from anchorwise.llm import packing, queries, text, wavelet
from anchorwise.llm.bpe import Replay

from .conftest import table


def tik(name):
    import tiktoken

    with open(P.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def hub():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path(queries.BPE_50K))
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_bpe_is_tiktoken_and_decodes(spark, folder):
    encoder = tik(queries.RANKS_MULTI)
    want = Counter()
    for i, t in table(spark, folder):
        ids = encoder.encode_ordinary(t or "")
        want[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, queries.op2_bpe(spark, folder).collect())) == want


def test_replay_takes_a_lower_rank_that_a_merge_makes_first(tmp_path):
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"ab", b"cab", b"aa", b"aaa"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    import tiktoken

    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    replay, rnd = Replay(str(path), P.PATTERN), np.random.default_rng(1)
    words = ["".join(rnd.choice(list("abc"), n)) for n in rnd.integers(1, 30, 500)]
    assert replay.merge([w.encode() for w in words]) == [e.encode_ordinary(w) if w.encode() not in tokens else replay.merge([w.encode()])[0] for w in words]


def test_units_cut_no_match(spark):
    import regex

    rnd = np.random.default_rng(2)
    alphabet = list("ab1.' \n\t\r") + [" ", " ", "é", "日", "\u0085", "\x1c", "в"]
    texts = ["".join(rnd.choice(alphabet, n)) for n in rnd.integers(0, 40, 3000)]
    import pyarrow as pa

    data, off = text.raw(pa.array(texts))
    starts, ends, bounds = text.units(data, off)
    cut = [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    find = regex.compile(P.PATTERN).findall
    for k, t in enumerate(texts):
        assert [m for u in cut[bounds[k] : bounds[k + 1]] for m in find(u)] == find(t)


def test_wavelet_shards_hold_the_ids_in_order(spark, folder, hub):
    rows = sorted(table(spark, folder), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for i, t in rows:
        ids = [*hub(t), queries.SHARD_END]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    got = sorted(map(tuple, queries.op3_wavelet(spark, folder).collect()), key=lambda r: r[1])
    assert got == want


def test_small_shards_and_occurrences(spark, edge, hub, tmp_path):
    docs = queries.documents(spark, edge)
    path = str(tmp_path / "shards")
    wavelet.write_shards(docs, path, P.path(queries.BPE_50K), 2, shard_tokens=500, partitions=3)
    flat = [i for _, t in table(spark, edge) for i in [*hub(t), 2]]
    assert spark.read.parquet(path).count() > 5
    assert wavelet.read_shards(spark, path).groupBy().sum("n_tokens").first()[0] == len(flat)
    for token in (2, flat[1000], 50_000):
        assert wavelet.occurrences(spark, path, token).groupBy().sum("n").first()[0] == flat.count(token)


@pytest.mark.parametrize("n, top", [(0, 5), (1, 1), (7, 2), (3000, 300), (5000, 70_000)])
def test_wavelet_answers(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    w = wavelet.Wavelet.from_bytes(wavelet.Wavelet.build(ids).to_bytes())
    assert np.array_equal(w.ids(), ids)
    for i in range(0, n, max(1, n // 50)):
        token = int(ids[i])
        places = np.flatnonzero(ids == token)
        assert w.access(i) == token and w.rank(token, i) == np.count_nonzero(ids[:i] == token) and w.count(token) == len(places)
        assert [w.select(token, k) for k in range(min(5, len(places)))] == places[:5].tolist() and w.select(token, len(places)) == -1
    assert w.count(1 << 20) == 0


def check_packed(got, want):
    """want: Counter of (doc_id, ids as a tuple)."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    pieces = Counter()
    for (i, ids), n in want.items():
        for s in range(0, len(ids), 2048):
            part = ids[s : s + 2048]
            pieces[(i, s, len(part), crc(part), len(ids))] += n
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == pieces
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    return sum(r["length"] for r in got) / (2048 * len(by_sequence))


def test_packing(spark, folder, hub):
    want = Counter((i, (*hub(t), queries.PACK_END)) for i, t in table(spark, folder))
    assert check_packed(queries.op4_packing(spark, folder).collect(), want) > 0.95


def test_best_fit_takes_the_tightest_window():
    rnd = np.random.default_rng(3)
    lengths = sorted(rnd.integers(1, 101, 2000).tolist(), reverse=True)
    windows, rooms = packing.Windows(100), []
    for n in lengths:
        fits = [r for r in rooms if r >= n]
        window, offset = windows.place(n)
        assert 100 - offset == (min(fits) if fits else 100)
        if fits:
            assert rooms[window] == min(fits)
        else:
            rooms.append(100)
        rooms[window] -= n


def test_no_rows(spark, empty):
    for q in (queries.op2_bpe, queries.op3_wavelet, queries.op4_packing):
        assert q(spark, empty).collect() == []


def test_packing_spreads_rows_of_one_id_and_one_long_document(spark):
    rows = [(None, f"text {k} " * (k % 5)) for k in range(200)] + [(7, "many words in a long text " * 6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = packing.pieces(docs, P.path(queries.BPE_50K), 1, 64)
    got = packing.pack(cut, 64).select("doc_id", "start", "length", "sequence_id", "offset", (F.col("sequence_id") / 2**33).cast("int").alias("task"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")  # so small a table would meet in one task by itself
    try:
        got = spark.createDataFrame(got.collect(), got.schema)
    finally:
        spark.conf.set(merge, before)
    tasks = {r["doc_id"]: r["n"] for r in got.groupBy("doc_id").agg(F.countDistinct("task").alias("n")).collect()}
    assert tasks[None] > 2 and tasks[7] > 2
    filled = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["n"] == r["end"] <= 64 for r in filled)
