"""Token-id files: one wavelet matrix per shard.

``write_shards`` sorts documents by doc_id into ranges, encodes them, appends the end id and writes shards of
whole documents. A shard is one row in a Parquet file of its own, written by Spark's committer, so a lost
executor's attempt leaves nothing behind and any store that Spark writes will do. The blob holds zstandard
compressed bit-planes, most significant bit first, with the count of ones before every 512th bit.

``Wavelet`` answers from a blob: ``access`` (the id at a position), ``rank`` (occurrences of an id before a
position), ``count``, ``select`` (position of the k-th occurrence) and ``ids`` (all of them).

Null texts count as empty and give the end id alone. Null doc_ids sort first; repeated doc_ids lie side by side,
ordered by text. An empty table gives no shard and no row. Other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import text as tx
from .shared import sized, stored
from .tokens import ended, loaded

MAGIC = b"WVM1"
STEP = 512  # bits between two counts of the rank directory
SHARD_TOKENS = 4_000_000
SHARD_SCHEMA = "part int, seq int, n_docs long, n_tokens long, doc_ids binary, doc_null binary, doc_ends binary, blob binary"


class Wavelet:
    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray], before: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.before = n, zeros, planes, before

    @classmethod
    def build(cls, ids: np.ndarray) -> Wavelet:
        """One stable partition by bit for each plane."""
        bits = max(1, int(ids.max()).bit_length() if len(ids) else 1)
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        zeros, planes, before = [], [], []
        for b in range(bits - 1, -1, -1):
            bit = ((now >> b) & 1).astype(bool)
            plane = np.packbits(bit, bitorder="little")
            planes.append(plane)
            before.append(cls._directory(plane))
            zeros.append(int(len(now) - np.count_nonzero(bit)))
            now = np.concatenate([now[~bit], now[bit]])
        return cls(len(ids), zeros, planes, before)

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        blocks = np.zeros(-(-len(plane) // (STEP // 8)) * (STEP // 8), np.uint8)
        blocks[: len(plane)] = plane
        ones = np.bitwise_count(blocks).reshape(-1, STEP // 8).sum(axis=1, dtype=np.uint32)
        return np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)

    def to_bytes(self) -> bytes:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        out = [MAGIC, struct.pack("<QB", self.n, len(self.planes))]
        for zeros, plane, before in zip(self.zeros, self.planes, self.before, strict=True):
            a, b = pack(plane.tobytes()), pack(before.tobytes())
            out += [struct.pack("<QQQ", zeros, len(a), len(b)), a, b]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Wavelet:
        import zstandard

        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        unpack = zstandard.ZstdDecompressor().decompress
        n, levels = struct.unpack_from("<QB", blob, 4)
        at, zeros, planes, before = 13, [], [], []
        for _ in range(levels):
            z, a, b = struct.unpack_from("<QQQ", blob, at)
            at += 24
            zeros.append(z)
            planes.append(np.frombuffer(unpack(blob[at : at + a]), np.uint8))
            before.append(np.frombuffer(unpack(blob[at + a : at + a + b]), np.uint32))
            at += a + b
        return cls(n, zeros, planes, before)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // STEP
        count = int(self.before[level][block])
        part = self.planes[level][block * STEP // 8 : i // 8]
        count += int(np.bitwise_count(part).sum())
        if i % 8:
            count += int(self.planes[level][i // 8] & ((1 << (i % 8)) - 1)).bit_count()
        return count

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(len(self.planes)):
            bit = int(self.planes[level][i // 8] >> (i % 8)) & 1
            ones = self._ones(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def rank(self, token: int, i: int) -> int:
        """Occurrences of the token among the first i ids."""
        lo, hi = self._range(token, 0, min(max(i, 0), self.n))
        return hi - lo

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        levels = len(self.planes)
        if token < 0 or token >> levels:
            return 0, 0
        for level in range(levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if token >> (levels - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the occurrence k (from 0) of the token, or -1."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            return -1
        i, levels = lo + k, len(self.planes)
        for level in range(levels - 1, -1, -1):
            i = self._place(level, i - self.zeros[level], 1) if token >> (levels - 1 - level) & 1 else self._place(level, i, 0)
        return i

    def _place(self, level: int, k: int, bit: int) -> int:
        """Position of the k-th (from 0) bit of this kind in a plane: a search in the directory, then in one block."""
        ones = self.before[level].astype(np.int64)
        counts = ones if bit else np.arange(len(ones)) * STEP - ones
        block = int(np.searchsorted(counts, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * STEP // 8 : (block + 1) * STEP // 8], bitorder="little")
        return block * STEP + int(np.flatnonzero(bits == bit)[k - int(counts[block])])

    def ids(self) -> np.ndarray:
        """All ids: the partitions are undone from the last plane to the first."""
        levels = len(self.planes)
        bits = [np.unpackbits(p, count=self.n, bitorder="little").astype(bool) for p in self.planes] if self.n else []
        values = np.zeros(self.n, np.uint32)
        for level in range(levels - 1, -1, -1):
            if not self.n:
                break
            low, z = bits.pop(), self.zeros[level]
            out = np.empty(self.n, np.uint32)
            out[~low] = values[:z]
            out[low] = values[z:] | np.uint32(1 << (levels - 1 - level))
            values = out
        return values


def write_shards(docs: DataFrame, path: str, vocabulary: str, end: int, shard_tokens: int = SHARD_TOKENS, partitions: int | None = None) -> None:
    """Encodes all texts, each followed by ``end``, into shard files under ``path`` in ascending doc_id order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, part, seq = loaded(vocabulary), TaskContext.get().partitionId(), 0
        ids, keys, nulls, ends, size = [], [], [], [], 0

        def shard() -> pa.RecordBatch:
            flat, stops = np.concatenate(ids), np.concatenate(ends)
            row = [part, seq, len(stops), len(flat), np.concatenate(keys).tobytes(), np.concatenate(nulls).tobytes(), stops.tobytes(), Wavelet.build(flat).to_bytes()]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], [c.split()[0] for c in SHARD_SCHEMA.split(", ")])

        for rows, data, off in tx.slices(batches, 2 * tx.SLICE_BYTES):
            flat, bounds = ended(*units.encode(data, off), end)
            doc_ids = rows.column("doc_id")
            nil = doc_ids.is_null().to_numpy(zero_copy_only=False)
            doc_ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
            lo = 0
            while lo < len(doc_ids):  # whole documents up to the shard's size
                hi = int(np.searchsorted(bounds, bounds[lo] + shard_tokens - size, side="right")) - 1
                hi = min(max(hi, lo + (not size)), len(doc_ids))
                if hi > lo:
                    ids.append(flat[bounds[lo] : bounds[hi]])
                    keys.append(doc_ids[lo:hi].astype(np.int64))
                    nulls.append(nil[lo:hi])
                    ends.append(size + bounds[lo + 1 : hi + 1] - bounds[lo])
                    size += int(bounds[hi] - bounds[lo])
                if hi < len(doc_ids) and size:
                    yield shard()
                    seq += 1
                    ids, keys, nulls, ends, size = [], [], [], [], 0
                lo = hi
        if size:
            yield shard()

    tx.small_batches(docs.sparkSession)
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = tx.keyed(docs).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(run, SHARD_SCHEMA).write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary, little-endian unsigned 32-bit)."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    # two levels: sums of the range partitions, then a running sum within each partition
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    parts = parts.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("part_start"))
    within = Window.partitionBy("part").orderBy("seq")
    starts = shards.select("part", "seq", (F.sum("n_tokens").over(within) - F.col("n_tokens")).alias("in_part")).join(parts, "part")
    starts = sized(stored(starts.select("part", "seq", (F.col("in_part") + F.col("part_start")).alias("shard_start")), "shard-starts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                got = {n: batch.column(n)[row].as_buffer() if n == "blob" else batch.column(n)[row].as_py() for n in batch.schema.names}
                flat = Wavelet.from_bytes(got["blob"].to_pybytes()).ids().astype("<u4")
                stops = np.frombuffer(got["doc_ends"], np.int64)
                begin = np.concatenate([[0], stops[:-1]])
                nil = np.frombuffer(got["doc_null"], bool)
                doc_ids = pa.array(np.frombuffer(got["doc_ids"], np.int64), mask=nil)
                for lo in range(0, len(stops), 1000):
                    hi = min(lo + 1000, len(stops))
                    base = int(begin[lo])
                    ids = pa.BinaryArray.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((4 * (np.append(begin[lo:hi], stops[hi - 1]) - base)).astype(np.int32)), pa.py_buffer(flat[base : stops[hi - 1]].tobytes())])
                    yield pa.RecordBatch.from_arrays([doc_ids[lo:hi], pa.array([got["part"]] * (hi - lo), pa.int32()), pa.array([got["seq"]] * (hi - lo), pa.int32()), pa.array(begin[lo:hi]), pa.array(stops[lo:hi] - begin[lo:hi]), ids], ["doc_id", "part", "seq", "at", "n_tokens", "ids"])

    docs = shards.mapInArrow(run, "doc_id long, part int, seq int, at long, n_tokens long, ids binary")
    return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids")


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """part, seq, n: how often the token stands in every shard, counted on the bit-planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [Wavelet.from_bytes(b.as_py()).count(token) for b in batch.column("blob")]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("seq"), pa.array(n, pa.int64())], ["part", "seq", "n"])

    return spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "seq", "blob").mapInArrow(run, "part int, seq int, n long")
