"""Katz backoff language model of order two, stored in partitioned tables.

P(w | v) = d(c(vw)) c(vw) / c(v) for pairs seen in training, else a(v) P(w); P(w) = d(c(w)) c(w) / (N Z) for known
words, and what discounting frees for the unknown word. d is Good-Turing's discount for counts up to ``K`` and 1
above; a(v) and Z are fixed so that each distribution sums to one exactly. The recursion ends at the unknown word.

Nothing is looked up token by token. Documents are dealt to chunks of bounded size by id, text, input partition and how
often the partition had both before, so rows that share an id, or are equal, spread over the chunks. If Spark reads the
input again, each partition must give the same rows, in any order. The work goes in three steps:

1. A chunk's distinct words go to word buckets, which add the counts, number the words and reply ids and counts.
2. The chunk sends its distinct word pairs, with their counts and the documents that have them, to context buckets.
   A bucket merges its pairs into its part of the stored table: contexts, followers, counts, and the integer sums
   from which backoff weights follow. A context with more tokens than ``hot`` is dealt over several buckets by
   follower; its sums are added up over them, and there are at most tokens / hot such contexts.
3. With the counts of counts known, each bucket of the table evaluates its pairs once and adds the logarithms to
   its documents; a document's score is the sum over the buckets.

So shuffles carry pairs distinct in a chunk, not tokens, and no word or context meets in one task.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, then one end, which also is the first word's context. Null
texts count as empty: one end. Rows are kept one for one, repeated ones too; an empty table gives no rows; without
training rows every score is that of unknown words, log10(1) = 0. Other columns are ignored.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import fresh

K = 5  # counts up to K are discounted
CHUNK_CHARS, BUCKET_CHARS = 8_000_000, 12_000_000  # what a task holds at a time; raise both with the executors' memory
END = ""  # no word is empty


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned integers in their least width, byte planes apart, compressed."""
    import zstandard

    out = []
    for a in arrays:
        width = 1 if not len(a) else (int(a.max()).bit_length() + 7) // 8 or 1
        planes = a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
        out.append(struct.pack("<QB", len(a), width) + planes)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(blob: bytes) -> list[np.ndarray]:
    import zstandard

    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        n, width = struct.unpack_from("<QB", data, at)
        at += 9
        full = np.zeros((n, 8), np.uint8)
        full[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T
        out.append(full.view("<u8").ravel().astype(np.int64))
        at += n * width
    return out


def ascending(a: np.ndarray) -> np.ndarray:
    """Steps of an ascending row: small numbers pack well."""
    return np.diff(a, prepend=0)


_BUNDLE = "chunk long, doc_ids array<long>, train array<boolean>, bytes array<long>, text binary"


def _bundle(chunks: int):
    """An input partition's documents in lower case, put together and compressed by chunk."""

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        partition, seen = TaskContext.get().partitionId(), {}
        for rows, data, off in tx.slices(batches, 4 * tx.SLICE_BYTES):
            data = tx.lowered(data)
            of = np.empty(rows.num_rows, np.int64)
            for k, key in enumerate(rows.column("key").to_pylist()):
                before = seen[key] = seen.get(key, -1) + 1
                of[k] = zlib.crc32(struct.pack("<qqq", key, partition, before)) % chunks
            doc_ids, train, sizes = rows.column("doc_id"), rows.column("train"), np.diff(off)
            for chunk in np.unique(of).tolist():
                at = np.flatnonzero(of == chunk)
                text = pack(b"".join(data[off[d] : off[d + 1]].tobytes() for d in at))
                lists = [pa.array([x], pa.list_(t)) for x, t in ((doc_ids.take(pa.array(at)), pa.int64()), (train.take(pa.array(at)), pa.bool_()), (sizes[at], pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *lists, pa.array([text], pa.binary())], ["chunk", "doc_ids", "train", "bytes", "text"])

    return run


def spread_hash(words: pa.LargeStringArray) -> np.ndarray:
    """64-bit hashes of distinct words that are not empty, and of the empty word behind them."""
    _, off, data = words.buffers()
    off = np.frombuffer(off, np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if len(words) else np.zeros(0, np.uint8)
    lens = np.diff(off)
    power = np.full(int(lens.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    at = np.arange(len(data)) - np.repeat(off[:-1] - off[0], lens)
    h = np.add.reduceat(power[at + 1] * data, off[:-1] - off[0]) if len(words) else np.zeros(0, np.uint64)
    h = np.append(h, np.uint64(0))
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


class Chunk:
    """The documents of a chunk as word numbers; words are numbered by bucket, then by hash and spelling."""

    def __init__(self, bundles: pa.Table, buckets: int):
        import zstandard

        data, sizes, train = [], [], []
        self.doc_ids = []
        for bundle in bundles.to_pylist():
            data.append(zstandard.ZstdDecompressor().decompress(bundle["text"]))
            sizes += bundle["bytes"]
            self.doc_ids += bundle["doc_ids"]
            train += bundle["train"]
        data, off = np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        starts, ends, bounds = tx.words(data, off)
        coded = tx.coded(data, starts, ends)
        self.n, self.train = len(train), np.array(train, bool)
        end, hashes = len(coded.dictionary), spread_hash(coded.dictionary)
        words = pa.concat_arrays([coded.dictionary, pa.array([END], pa.large_string())])
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((hashes, bucket))
        if (np.diff(hashes[order]) == 0).any():  # equal hashes: by spelling
            table = pa.table({"bucket": bucket, "hash": hashes, "word": words})
            order = pc.sort_indices(table, [(c, "ascending") for c in table.column_names]).to_numpy()
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        self.words, self.bucket = words.take(pa.array(order)), bucket[order]
        self.bounds = bounds + np.arange(self.n + 1)  # with an end after each document
        self.tokens = place[np.insert(coded.indices.to_numpy().astype(np.int64), bounds[1:], end)]
        self.end = int(place[end])
        self.doc = tx.by_doc(self.bounds)

    def counts(self) -> np.ndarray:
        """Training tokens of each word."""
        return np.bincount(self.tokens[self.train[self.doc]], minlength=len(self.words))


_WORDS = "bucket long, chunk long, words binary, counts binary"
_REPLY = "chunk long, bucket long, reply binary, stats array<long>"
_SENT = "bucket long, chunk long, stats array<long>, pairs binary, docs binary, doc_ids array<long>, n_tokens array<long>, n_known array<long>, base array<double>"
_STATE = "bucket long, kind string, stats array<long>, hot array<struct<id:long,sums:array<long>>>, contexts binary, pairs binary, chunks array<struct<chunk:long,docs:binary>>, chunk long, doc_ids array<long>, n_tokens array<long>, n_known array<long>, base array<double>"


def _send_words(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        import zstandard

        chunk = Chunk(table, buckets)
        counts, zip_ = chunk.counts(), zstandard.ZstdCompressor(level=1).compress
        text, off = tx.raw(chunk.words)
        stops = np.searchsorted(chunk.bucket, np.arange(buckets + 1))
        rows = [(b, zip_(text[off[lo] : off[hi]].tobytes()), pack(np.diff(off[lo : hi + 1]), counts[lo:hi])) for b, (lo, hi) in enumerate(zip(stops[:-1], stops[1:], strict=True)) if hi > lo]
        number = table.column("chunk")[0].as_py()
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()), "chunk": pa.array([number] * len(rows), pa.int64()), "words": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _number_words(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        import zstandard

        unzip = zstandard.ZstdDecompressor().decompress
        chunks, sizes, counts = table.column("chunk").to_pylist(), [], []
        for blob in table.column("counts").to_pylist():
            lens, n = unpack(blob)
            sizes.append(lens)
            counts.append(n)
        off = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        text = b"".join(unzip(blob) for blob in table.column("words").to_pylist())
        coded = pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(off), pa.py_buffer(text)).dictionary_encode()
        code = coded.indices.to_numpy()
        total = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(total, code, np.concatenate(counts))
        bucket = table.column("bucket")[0].as_py()
        order = pc.sort_indices(coded.dictionary).to_numpy()  # ids do not depend on the order of the rows
        ids = np.empty(len(order), np.int64)
        ids[order] = np.arange(len(order)) * buckets + bucket
        stops = np.cumsum([len(x) for x in sizes])[:-1]
        replies = [pack(ids[part], total[part]) for part in np.split(code, stops)]
        known = total[total > 0]
        stats = [len(known), int(known.sum()), *[int((known == r).sum()) for r in range(1, K + 2)]]
        stats = [stats] + [None] * (len(chunks) - 1)  # with one reply, so that they are added once
        return pa.table({"chunk": pa.array(chunks, pa.int64()), "bucket": pa.array([bucket] * len(chunks), pa.int64()), "reply": pa.array(replies, pa.binary()), "stats": pa.array(stats, pa.list_(pa.int64()))})

    return run


def _send_pairs(buckets: int, hot: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = Chunk(table, buckets)
        number = table.column("chunk")[0].as_py()
        got = [unpack(r) for r in replies.sort_by("bucket").column("reply").to_pylist()]
        ids, counts = (np.concatenate([g[i] for g in got]) for i in range(2))
        if len(ids) != len(chunk.words):
            raise ValueError("the documents were not the same when they were read again")
        before = np.empty_like(chunk.tokens)
        before[1:] = chunk.tokens[:-1]
        before[chunk.bounds[:-1]] = chunk.end
        n = len(chunk.words)
        # one stable sort by the ids of both words: documents stay in order, and a posting - a pair in a document, with
        # its number of occurrences - is a run of equal (pair, document)
        by_id = np.argsort(ids)
        rank = np.empty(n, np.int64)
        rank[by_id] = np.arange(n)
        key = rank[before] * n + rank[chunk.tokens]
        order = np.argsort(key, kind="stable")
        key, doc = key[order], chunk.doc[order]
        del order, before
        other = np.concatenate([[True], key[1:] != key[:-1]])
        posting = np.flatnonzero(other | np.concatenate([[True], doc[1:] != doc[:-1]]))
        at = np.flatnonzero(other)
        trained = np.add.reduceat(chunk.train[doc].astype(np.int64), at)
        p_doc, times, begin = doc[posting].astype(np.int32), np.diff(posting, append=len(doc)), np.searchsorted(posting, at)
        n_postings = np.diff(begin, append=len(posting))
        c1, c2 = by_id[key[at] // n], by_id[key[at] % n]
        del key, doc, other, posting
        parts = -(-counts[c1] // hot)  # a hot context lies in so many buckets
        spread = np.where(parts > 1, (ids[c2] * 0x9E3779B1 >> 16) % np.maximum(parts, 1), 0)
        bucket = ((ids[c1] * 0x9E3779B1 >> 8) + spread) % buckets
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        moved, p_stop = tx.gather(np.arange(len(p_doc)), begin, n_postings, order)
        p_doc, times, n_postings = p_doc[moved], times[moved], n_postings[order]
        bucket, c1, c2, trained = bucket[order], c1[order], c2[order], trained[order]
        out: dict[str, list] = {c.split()[0]: [] for c in _SENT.split(", ")}
        stops = np.searchsorted(bucket, np.arange(buckets + 1))
        for b, (lo, hi) in enumerate(zip(stops[:-1], stops[1:], strict=True)):
            if hi == lo:
                continue
            at = lo + np.flatnonzero(np.concatenate([[True], c1[lo + 1 : hi] != c1[lo : hi - 1]]))
            context = c1[at]
            followers = np.diff(np.append(at, hi))
            p_lo, p_hi = p_stop[lo], p_stop[hi]
            out["bucket"].append(b)
            out["chunk"].append(number)
            out["pairs"].append(pack(ascending(ids[context]), counts[context], followers, ids[c2[lo:hi]], counts[c2[lo:hi]], trained[lo:hi]))
            out["docs"].append(pack(n_postings[lo:hi], p_doc[p_lo:p_hi], times[p_lo:p_hi]))
            for c in ("stats", "doc_ids", "n_tokens", "n_known", "base"):
                out[c].append(None)
        known = counts[chunk.tokens]
        out["bucket"].append(buckets + number)  # a group of its own: what the chunk knows of its documents
        out["chunk"].append(number)
        out["stats"].append(np.sum([x for x in replies.column("stats").to_pylist() if x] or [[0] * (3 + K)], axis=0))
        out["pairs"].append(None)
        out["docs"].append(None)
        out["doc_ids"].append(chunk.doc_ids)
        out["n_tokens"].append(np.diff(chunk.bounds))
        out["n_known"].append(tx.total(chunk.bounds, known > 0).astype(np.int64))
        out["base"].append(tx.total(chunk.bounds, np.log10(known + 0.5)))
        longs = pa.list_(pa.int64())
        types = [pa.int64(), pa.int64(), longs, pa.binary(), pa.binary(), longs, longs, longs, pa.list_(pa.float64())]
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types, strict=True)})

    return run


def sums(context: np.ndarray, n_contexts: int, pair_count: np.ndarray, word_count: np.ndarray) -> np.ndarray:
    """Of the pairs seen in training, for each context: pairs of count 1..K, followers of count 1..K, tokens of the other followers."""
    seen = pair_count > 0
    out = [np.bincount(context[seen & (pair_count == r)], minlength=n_contexts) for r in range(1, K + 1)]
    out += [np.bincount(context[seen & (word_count == r)], minlength=n_contexts) for r in range(1, K + 1)]
    many = seen & (word_count > K)
    big = np.zeros(n_contexts, np.int64)
    np.add.at(big, context[many], word_count[many])
    return np.stack([*out, big], axis=1).astype(np.int64)


def _merge(buckets: int, hot: int):
    """A bucket of the stored table from all chunks' pairs."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        bucket = rows[0]["bucket"]
        if bucket >= buckets:
            return _state([{"bucket": bucket, "kind": "chunk", **{c: r[c] for c in ("chunk", "stats", "doc_ids", "n_tokens", "n_known", "base")}} for r in rows])
        parts = [unpack(r["pairs"]) for r in rows]
        for p in parts:
            p[0] = np.cumsum(p[0])
        first = np.concatenate([np.repeat(p[0], p[2]) for p in parts])
        first_count = np.concatenate([np.repeat(p[1], p[2]) for p in parts])
        second, second_count, trained = (np.concatenate([p[i] for p in parts]) for i in (3, 4, 5))
        order = np.lexsort((second, first))
        f, s = first[order], second[order]
        new = np.concatenate([[True], (f[1:] != f[:-1]) | (s[1:] != s[:-1])])
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        f, s, c2, c1 = f[at], s[at], second_count[order][at], first_count[order][at]
        pair_count = np.add.reduceat(trained[order], at)
        new = np.concatenate([[True], f[1:] != f[:-1]])
        context, at = np.cumsum(new) - 1, np.flatnonzero(new)
        total = sums(context, len(at), pair_count, c2)
        wide = c1[at] > hot
        stats = [int((pair_count == r).sum()) for r in range(1, K + 2)]
        chunks, lo = [], 0
        for row, part in zip(rows, parts, strict=True):
            n = len(part[3])
            postings, doc, times = unpack(row["docs"])
            chunks.append({"chunk": row["chunk"], "docs": pack(ascending(place[lo : lo + n]), postings, doc, times)})
            lo += n
        return _state([{
            "bucket": bucket, "kind": "pairs", "stats": stats,
            "hot": [{"id": int(i), "sums": t} for i, t in zip(f[at][wide], total[wide].tolist(), strict=True)],
            "contexts": pack(ascending(f[at]), c1[at], np.diff(np.append(at, len(f))), *total.T),
            "pairs": pack(s, c2, pair_count), "chunks": chunks,
        }])

    return run


def _state(rows: list[dict]) -> pa.Table:
    longs = pa.list_(pa.int64())
    types = {
        "bucket": pa.int64(), "kind": pa.string(), "stats": longs, "hot": pa.list_(pa.struct([("id", pa.int64()), ("sums", longs)])),
        "contexts": pa.binary(), "pairs": pa.binary(), "chunks": pa.list_(pa.struct([("chunk", pa.int64()), ("docs", pa.binary())])),
        "chunk": pa.int64(), "doc_ids": longs, "n_tokens": longs, "n_known": longs, "base": pa.list_(pa.float64()),
    }
    return pa.table({c: pa.array([r.get(c) for r in rows], t) for c, t in types.items()})


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing discounts d[r] of counts r = 0..K from the counts of counts n[1..K+1] (n[0] is count 1); d[0] is 0.

    Groups of copies push up single counts of counts, so the formula takes them from the line that fits
    log n[r] over log r best (Gale and Sampson's smoothing), on every table. With slope s they are in proportion to
    r ** s, and all discounts lie in 0 to 1 for s below -1. A table too small or too odd for such a line has Zipf's -2."""
    r = np.arange(1, K + 2)
    seen = np.array(n[: K + 1], float)
    at = seen > 0
    slope = np.polyfit(np.log(r[at]), np.log(seen[at]), 1)[0] if at.sum() > 1 else -2.0
    if not slope < -1:
        slope = -2.0
    common = (K + 1.0) ** (slope + 1)  # (K + 1) n[K + 1] / n[1]
    ratio = (1 + 1 / r[:K]) ** (slope + 1)  # (r + 1) n[r + 1] / (r n[r])
    return np.concatenate([[0.0], (ratio - common) / (1 - common)])


class Model:
    """What the counts of counts fix: discounts of words and pairs, and the unigrams' normaliser."""

    def __init__(self, types: int, tokens: int, n_words: list[int], n_pairs: list[int]):
        """n_words, n_pairs: how many words or pairs have the counts 1..K+1."""
        self.types, self.tokens = types, tokens
        self.word_discount, self.pair_discount = discounts(n_words), discounts(n_pairs)
        # mass that discounting frees among the words goes to the unknown word; it has at least one token's
        freed = sum(r * n_words[r - 1] * (1 - self.word_discount[r]) for r in range(1, K + 1))
        self.freed = freed if freed > 0 else 1.0
        self.norm = self.tokens if freed > 0 else self.tokens + 1.0

    def words(self, count: np.ndarray) -> np.ndarray:
        """P(w) by the word's count; 0 is the unknown word."""
        if not self.tokens:
            return np.ones(len(count))
        d = np.where(count > K, 1.0, self.word_discount[np.minimum(count, K)])
        return np.where(count > 0, d * count, self.freed) / self.norm

    def backoff(self, context_count: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Denominator of the seen pairs and backoff weight, by context, from its count and its sums."""
        r = np.arange(1, K + 1)
        freed = total[:, :K] @ (r * (1 - self.pair_discount[1:]))
        spare = np.where(freed > 0, freed, 1.0)  # nothing to discount: one more token
        base = np.where(freed > 0, context_count, context_count + 1.0)
        seen = (total[:, K : 2 * K] @ (r * self.word_discount[1:]) + total[:, 2 * K]) / self.norm if self.tokens else np.zeros(len(total))
        weight = spare / np.maximum(base, 1) / np.maximum(1 - seen, 1e-300)
        return base, np.where(context_count > 0, weight, 1.0)


def _evaluate(model: Model, sent):
    def run(batches):
        hot = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                steps, c1, followers, *total = unpack(row["contexts"])
                ids = np.cumsum(steps)
                _, c2, pair_count = unpack(row["pairs"])
                total = np.stack(total, axis=1)
                for k in np.flatnonzero([i in hot for i in ids.tolist()]):
                    total[k] = hot[int(ids[k])]
                base, weight = model.backoff(c1, total)
                context = np.repeat(np.arange(len(ids)), followers)
                d = np.where(pair_count > K, 1.0, model.pair_discount[np.minimum(pair_count, K)])
                p = np.where(pair_count > 0, d * pair_count / np.maximum(base[context], 1), weight[context] * model.words(c2))
                logs = np.log10(p)
                for part in row["chunks"]:
                    steps, postings, doc, times = unpack(part["docs"])
                    score = np.bincount(doc, weights=np.repeat(logs[np.cumsum(steps)], postings) * times)
                    yield pa.RecordBatch.from_arrays([pa.array([part["chunk"]], pa.int64()), pa.array([score], pa.list_(pa.float64()))], ["chunk", "part"])

    return run


def _add_up(chunk: pa.Table, parts: pa.Table) -> pa.Table:
    columns = {c: [] for c in ("doc_id", "n_tokens", "n_known", "base", "score")}
    for row in chunk.to_pylist():
        score = np.zeros(len(row["n_tokens"]))
        for part in parts.column("part"):
            values = part.values.to_numpy(zero_copy_only=False)
            score[: len(values)] += values
        for c, v in zip(columns, (row["doc_ids"], row["n_tokens"], row["n_known"], row["base"], score), strict=True):
            columns[c].extend(v)
    return pa.table({c: pa.array(v, pa.int64() if c in ("doc_id", "n_tokens", "n_known") else pa.float64()) for c, v in columns.items()})


def deal(rows: DataFrame, chunks: int) -> DataFrame:
    """Bundles of documents with the number of their chunk."""
    return rows.withColumn("key", F.xxhash64("doc_id", "text")).mapInArrow(_bundle(chunks), _BUNDLE)


def fit_and_score(docs: DataFrame, train: Column, path: str | None = None) -> DataFrame:
    """doc_id, train, n_tokens, n_known, base_score, score, train_tokens, types of every text; rows with ``train`` teach.

    The model's table is written below ``path`` (by default a new folder in the shared one)."""
    spark = docs.sparkSession
    tx.small_batches(spark)
    path = path or fresh(spark, "katz")
    rows = tx.keyed(docs, train.alias("train"))
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"), F.count("*").alias("n")).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks, buckets = (max(least, math.ceil(size["chars"] / n)) for n in (CHUNK_CHARS, BUCKET_CHARS))
    hot = max(1000, (size["chars"] // 6 + size["n"]) // (4 * buckets))
    dealt = deal(rows, chunks)
    words = dealt.groupBy("chunk").applyInArrow(_send_words(buckets), _WORDS)
    replies = words.groupBy("bucket").applyInArrow(_number_words(buckets), _REPLY)
    pairs = dealt.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_send_pairs(buckets, hot), _SENT)
    pairs.groupBy("bucket").applyInArrow(_merge(buckets, hot), _STATE).write.option("compression", "uncompressed").parquet(path)
    return score(spark, path)


def score(spark, path: str) -> DataFrame:
    """Scores of the documents in a stored model's table."""
    state = spark.read.schema(_STATE).parquet(path)
    tables = state.where("kind = 'pairs'")
    stats = {r["kind"]: [int(x or 0) for x in r[1:]] for r in state.groupBy("kind").agg(*[F.sum(F.get("stats", F.lit(i))) for i in range(3 + K)]).collect()}
    words, n_pairs = stats.get("chunk", [0] * (3 + K)), stats.get("pairs", [0] * (3 + K))
    model = Model(words[0], words[1], words[2:], n_pairs[: K + 1])
    # at most tokens / hot contexts
    hot = tables.select(F.explode("hot").alias("h")).groupBy("h.id").agg(*[F.sum(F.col("h.sums")[i]).alias(f"s{i}") for i in range(2 * K + 1)])
    sent = spark.sparkContext.broadcast({r["id"]: [r[f"s{i}"] for i in range(2 * K + 1)] for r in hot.collect()})
    parts = tables.select("contexts", "pairs", "chunks").mapInArrow(_evaluate(model, sent), "chunk long, part array<double>")
    chunks = state.where("kind = 'chunk'").select("chunk", "doc_ids", "n_tokens", "n_known", "base")
    scored = chunks.groupBy("chunk").cogroup(parts.groupBy("chunk")).applyInArrow(_add_up, "doc_id long, n_tokens long, n_known long, base double, score double")
    norm = math.log10(model.tokens + 0.5 * (model.types + 1))
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * F.lit(norm)).alias("base_score"), "score")
