"""Exact deduplication with counting quotient filters.

Every input partition builds a filter of its texts' fingerprints: a fingerprint's high bits are its quotient, its
low bits the remainder; the remainders of a quotient form a sorted run, with a counter each. All filters split
fingerprints alike, so two of them merge without loss by merging sorted runs and adding counters. The filters are
cut by quotient ranges, each range is merged in one task, and the fingerprints with a count above one are stored.

Only texts with such a fingerprint are compared byte by byte: they are grouped by the whole normalised text, with
partial aggregation before the shuffle, so a text that fills a third of the table is one row of each task.

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` becomes one space. Null counts as empty.
Of equal texts the row with the smallest doc_id stays; null ids are larger than all others. Where several rows have
that id, or no row has any, they are stored with a row key, and of them the smallest key stays: exactly one row of equal
texts is kept. An empty table gives no rows. ``annotate`` carries all columns in a struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import sized, stored

BITS = 64  # of a fingerprint
RANGE_BITS = 10  # quotient ranges in which filters are cut and merged
QUOTIENT_BITS = 20
SLICE = "range int, occupied binary, run_ends binary, remainders binary, counts binary"


class QuotientFilter:
    """Counting quotient filter over a range of quotients.

    ``occupied`` has a bit for each quotient of the range, ``run_ends`` one for each slot; the slots hold the
    remainders, sorted in each run, and their counts."""

    def __init__(self, occupied: np.ndarray, run_ends: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.occupied, self.run_ends, self.remainders, self.counts = occupied, run_ends, remainders, counts

    @classmethod
    def build(cls, quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray, size: int) -> QuotientFilter:
        """From (quotient, remainder, count) in any order; equal ones are added."""
        order = np.lexsort((remainders, quotients))
        q, r, c = quotients[order], remainders[order], counts[order]
        if not len(q):
            return cls(np.zeros(-(-size // 8), np.uint8), np.zeros(0, np.uint8), r, c)
        new = np.concatenate([[True], (q[1:] != q[:-1]) | (r[1:] != r[:-1])])
        at = np.flatnonzero(new)
        q, r, c = q[at], r[at], np.add.reduceat(c, at)
        occupied = np.zeros(size, bool)
        occupied[q] = True
        return cls(np.packbits(occupied), np.packbits(np.append(q[1:] != q[:-1], True)), r, c)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Quotients, remainders and counts: the k-th run belongs to the k-th occupied quotient."""
        quotients = np.flatnonzero(np.unpackbits(self.occupied))
        ends = np.unpackbits(self.run_ends, count=len(self.remainders)).astype(np.int64)
        return quotients[np.cumsum(ends) - ends] if len(ends) else quotients[:0], self.remainders, self.counts

    @classmethod
    def merge(cls, filters: list[QuotientFilter], size: int) -> QuotientFilter:
        """Sorted runs of equal quotients are merged, counters of equal remainders added; nothing is lost."""
        parts = [f.entries() for f in filters]
        return cls.build(*(np.concatenate([p[i] for p in parts]) for i in range(3)), size)


def _cut(fingerprints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Range, quotient within the range, and remainder of ``bits``-bit fingerprints."""
    q = min(QUOTIENT_BITS, bits)
    r = min(RANGE_BITS, q)
    quotient = (fingerprints >> np.uint64(bits - q)).astype(np.int64)
    remainder = fingerprints & np.uint64((1 << (bits - q)) - 1)
    return quotient >> (q - r), quotient & ((1 << (q - r)) - 1), remainder


def duplicate_fingerprints(fingerprints: DataFrame, bits: int = BITS) -> DataFrame:
    """fp of all fingerprints (a long column fp) that occur more than once, with their count n."""
    q, r = min(QUOTIENT_BITS, bits), min(RANGE_BITS, bits)
    size = 1 << (q - r)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b.column(0).to_numpy().view(np.uint64) for b in batches if b.num_rows]
        if not held:
            return
        ranges, quotients, remainders = _cut(np.concatenate(held), bits)
        order = np.argsort(ranges, kind="stable")
        ids, at = np.unique(ranges[order], return_index=True)
        rows = []
        for k, part in zip(ids.tolist(), np.split(order, at[1:]), strict=True):
            f = QuotientFilter.build(quotients[part], remainders[part], np.ones(len(part), np.int64), size)
            rows.append((k, f.occupied.tobytes(), f.run_ends.tobytes(), f.remainders.tobytes(), f.counts.tobytes()))
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], [c.split()[0] for c in SLICE.split(", ")])

    def merge(table: pa.Table) -> pa.Table:
        kinds = (np.uint8, np.uint8, np.uint64, np.int64)
        filters = [QuotientFilter(*(np.frombuffer(row[c], t) for c, t in zip(("occupied", "run_ends", "remainders", "counts"), kinds, strict=True))) for row in table.to_pylist()]
        quotients, remainders, counts = QuotientFilter.merge(filters, size).entries()
        more = counts > 1
        high = (np.uint64(table.column("range")[0].as_py()) << np.uint64(q - r)) | quotients[more].astype(np.uint64)
        fp = (high << np.uint64(bits - q) if bits > q else high) | remainders[more]
        return pa.table({"fp": pa.array(fp.view(np.int64)), "n": pa.array(counts[more], pa.int64())})

    return fingerprints.mapInArrow(build, SLICE).groupBy("range").applyInArrow(merge, "fp long, n long")


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def annotate(docs: DataFrame, carry: list[str] | None = None, bits: int = BITS) -> DataFrame:
    """row (struct of the carried columns, all by default), doc_id, keep_id, group_size, kept, text_sha256."""
    carried = F.struct(*[F.col(f"`{c}`") for c in (carry if carry is not None else docs.columns)])
    hashed = docs.select(carried.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("norm"))
    fp = F.xxhash64("norm")
    hashed = hashed.withColumn("fp", fp if bits == 64 else F.pmod(fp, F.lit(1 << bits)))
    twice = sized(stored(duplicate_fingerprints(hashed.select("fp"), bits), "dedup-fingerprints").select("fp"))
    same = hashed.select("doc_id", "fp", "norm").join(twice, "fp", "left_semi").select("*", F.sha2("norm", 256).alias("text_sha256"))
    same = stored(same, "dedup-candidates")
    groups = same.groupBy("fp", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.where("group_size > 1").select(F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    groups = sized(stored(groups, "dedup-groups"))
    least = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    tied = same.select("doc_id", "text_sha256").join(groups, "text_sha256").where(least).groupBy("text_sha256").count()
    tied = stored(tied.where("count > 1").select("text_sha256", F.lit(True).alias("tied")), "dedup-tied")
    rows = hashed.select("row", "doc_id", F.sha2("norm", 256).alias("text_sha256")).join(groups, "text_sha256", "left")
    alone = F.col("group_size").isNull()
    if tied.isEmpty():
        decided = rows.withColumn("kept", alone | least)
    else:
        rows = rows.join(sized(tied), "text_sha256", "left").withColumn("open", F.coalesce("tied", F.lit(False)) & least).drop("tied")
        open_ = stored(rows.where("open").withColumn("key", F.monotonically_increasing_id()), "dedup-open")
        first = sized(stored(open_.groupBy("text_sha256").agg(F.min("key").alias("first")), "dedup-first"))
        open_ = open_.join(first, "text_sha256").withColumn("kept", F.col("key") == F.col("first")).drop("key", "first")
        decided = rows.where("not open").withColumn("kept", alone | least).unionByName(open_)
    return decided.select(
        "row",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "kept",
        "text_sha256",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with its columns."""
    kept = annotate(docs).where("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
