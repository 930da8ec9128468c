"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are sorted by population count and cut into tiles of about equal size. Two tiles are compared
only if their population counts come within the radius, since k differing bits change the count by k at most. Each
remaining pair of tiles is one group of a Spark shuffle; in it, blocks are compared by numpy exclusive-or and bit
counts, after the same test on the population counts of the fingerprints' four quarters, whose differences add up.

A pair of tiles reports a spanning forest of its links, so a group of thousands of near copies gives about as many
edges as members and no component loses a link. ``components`` joins the forests.

Null texts count as empty; texts without words have fingerprint 0, linked like any other. Null doc_ids are never a
component's id unless it has no other. Repeated rows each get their result; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .components import components
from .shared import sized, stored

SHINGLE, SEED, RADIUS = 3, 42, 3
BLOCK = 256
SLICE = 1 << 20  # bytes of text at a time: about 50 bytes of arrays for each
TILE_LEAST, TILE_MOST, TILES = 4096, 131072, 256
_ONE = np.uint64(1)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for rows, data, off in tx.slices(batches, SLICE):
            data = tx.lowered(data)
            starts, ends, bounds = tx.words(data, off)
            letters = ends - starts
            before = np.cumsum(letters) - letters
            at = np.arange(int(letters.sum()))
            to = before + np.arange(len(letters))  # the words again, each with one space after it
            spaced = np.full(len(at) + len(letters), 32, np.uint8)
            spaced[at + np.repeat(to - before, letters)] = data[at + np.repeat(starts - before, letters)]
            n = np.diff(bounds)
            parts = np.where(n > 0, np.maximum(n - shingle + 1, 1), 0)
            doc = np.repeat(np.arange(len(n)), parts)
            first = bounds[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            last = np.minimum(first + shingle, bounds[doc + 1]) - 1
            text = spaced.tobytes()
            begin, end = to[first].tolist(), (to[last] + letters[last]).tolist()
            h = np.array([xxh64_intdigest(text[a:b], SEED) for a, b in zip(begin, end, strict=True)], np.uint64)
            fp = np.zeros(len(n), np.uint64)
            some = np.flatnonzero(parts)
            if len(some):
                at = (np.cumsum(parts) - parts)[some]
                for bit in range(64):
                    ones = np.add.reduceat((h >> np.uint64(bit)) & _ONE, at)
                    fp[some] |= (2 * ones > parts[some].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    tx.small_batches(docs.sparkSession)
    return tx.keyed(docs).mapInArrow(run, "doc_id long, fp long")


def _blocks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the quarters' population counts; least and greatest of them in each block."""
    quarters = np.bitwise_count(np.ascontiguousarray(x).view(np.uint16).reshape(-1, 4)).astype(np.int16)
    order = np.lexsort(quarters.T[::-1])
    q = quarters[order]
    at = np.arange(0, len(q), BLOCK)
    return order, np.minimum.reduceat(q, at), np.maximum.reduceat(q, at)


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def forest(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links between two tiles, or within one, as index pairs into a followed by b."""
    order_a, low_a, high_a = _blocks(a)
    order_b, low_b, high_b = (order_a, low_a, high_a) if b is None else _blocks(b)
    shift = 0 if b is None else len(a)
    x, y = a[order_a], (a if b is None else b)[order_b]
    parent = list(range(len(a) + (0 if b is None else len(b))))
    edges = []
    for i in range(len(low_a)):
        gap = np.maximum(0, np.maximum(low_b - high_a[i], low_a[i] - high_b)).sum(axis=1)
        part = x[i * BLOCK : (i + 1) * BLOCK]
        for j in np.flatnonzero(gap <= radius):
            if b is None and j < i:
                continue
            near = np.bitwise_count(part[:, None] ^ y[None, j * BLOCK : (j + 1) * BLOCK]) <= radius
            if b is None and i == j:
                near &= ~np.tri(len(part), dtype=bool)
            if not near.any():
                continue
            r, c = _thinned(near, b is None and i == j)
            for u, v in zip((order_a[r + i * BLOCK]).tolist(), (order_b[c + j * BLOCK] + shift).tolist(), strict=True):
                ru, rv = _root(parent, u), _root(parent, v)
                if ru != rv:
                    parent[rv] = ru
                    edges.append((u, v))
    return edges


def _thinned(near: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links of a block that keep its components: all of few, else each row's and column's link to a common one."""
    if np.count_nonzero(near) <= 4 * sum(near.shape):
        return np.nonzero(near)
    if same:
        near = near | near.T | np.eye(len(near), dtype=bool)
    rows, cols = np.arange(near.shape[0]), np.full(near.shape[1], -1)
    big = sum(near.shape) + 1
    while True:  # least label over the links, until nothing changes
        new = np.where(near, rows[:, None], big).min(axis=0)
        back = np.minimum(rows, np.where(near, new[None, :], big).min(axis=1))
        if np.array_equal(new, cols) and np.array_equal(back, rows):
            break
        rows, cols = back, new
    # a breadth-first tree from each component's least row, which all its links lead to
    seen_r, seen_c = rows == np.arange(near.shape[0]), np.zeros(near.shape[1], bool)
    out_r, out_c = [], []
    while True:
        hit = near & seen_r[:, None] & ~seen_c[None, :]
        c = np.flatnonzero(hit.any(axis=0))
        out_r.append(hit[:, c].argmax(axis=0))
        out_c.append(c)
        seen_c[c] = True
        hit = near & seen_c[None, :] & ~seen_r[:, None]
        r = np.flatnonzero(hit.any(axis=1))
        out_r.append(r)
        out_c.append(hit[r].argmax(axis=1))
        seen_r[r] = True
        if not len(c) and not len(r):
            return np.concatenate(out_r), np.concatenate(out_c)


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges a, b that connect all fingerprints (distinct, a stored column fp) within the radius of each other."""
    n = distinct.count()
    size = min(max(TILE_LEAST, math.ceil(n / TILES)), TILE_MOST)
    count = F.bit_count("fp").cast("int")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        ones = np.concatenate([b.column("ones").to_numpy() for b in held])
        fps = np.concatenate([b.column("fp").to_numpy() for b in held])
        base = TaskContext.get().partitionId() << 32
        for k, lo in enumerate(range(0, len(fps), size)):
            part = slice(lo, lo + size)
            row = [base + k, int(ones[part][0]), int(ones[part][-1]), fps[part].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["tile", "least", "most", "fps"])

    sorted_fps = distinct.select("fp", count.alias("ones")).repartitionByRange(max(1, math.ceil(n / size)), "ones", "fp").sortWithinPartitions("ones", "fp")
    tiled = stored(sorted_fps.mapInArrow(tiles, "tile long, least int, most int, fps binary"), "tiles")
    # tiles are in order of population count: partners of a tile begin between its least and its most plus the radius
    reach = tiled.select(F.col("tile").alias("t1"), F.explode(F.sequence(F.col("least"), F.col("most") + radius)).alias("least"))
    pairs = reach.join(tiled.select(F.col("tile").alias("t2"), "least"), "least").where("t1 <= t2").select("t1", "t2")
    sides = pairs.withColumn("tile", F.explode(F.array_distinct(F.array("t1", "t2")))).join(tiled.select("tile", "fps"), "tile")

    def compare(table: pa.Table) -> pa.Table:
        sides = [np.frombuffer(x, np.uint64) for _, x in sorted(zip(table.column("tile").to_pylist(), table.column("fps").to_pylist(), strict=True))]
        a, b = sides[0], sides[1] if len(sides) > 1 else None
        found = np.array(forest(a, b, radius), np.int64).reshape(-1, 2)
        both = (a if b is None else np.concatenate([a, b])).view(np.int64)
        return pa.table({"a": both[found[:, 0]], "b": both[found[:, 1]]})

    return sides.groupBy("t1", "t2").applyInArrow(compare, "a long, b long")


def _components_of(fps: DataFrame, radius: int) -> DataFrame:
    """fp, root, component_id (the smallest doc_id that links reach) of the distinct stored fingerprints."""
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints-distinct")
    roots = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored(rooted.join(least, "root").select("fp", "root", "component_id"), "fingerprints-named")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that links reach) of every document."""
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    return fps.join(sized(_components_of(fps, radius).drop("root")), "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of docs for each component, with its columns: the one of the smallest doc_id, nulls last. Rows without an
    id, or with one that other rows have too, are told apart by a row key that is stored with them; the smallest stays."""
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    named = _components_of(fps, radius)
    gone = fps.join(sized(named.drop("root")), "fp").where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    gone = sized(stored(gone, "near-duplicates"))
    own = docs["doc_id"].cast("long")
    repeated = stored(fps.groupBy(F.col("doc_id").alias("id")).count().where("count > 1 or id is null").select("id"), "repeated-ids")
    if repeated.isEmpty():
        return docs.join(gone, own == gone["gone"], "left_anti")
    repeated = sized(repeated)
    clean = docs.join(repeated, own.eqNullSafe(repeated["id"]), "left_anti")
    clean = clean.join(gone, clean["doc_id"].cast("long") == gone["gone"], "left_anti")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.join(repeated, own.eqNullSafe(repeated["id"]), "left_semi").select(row, F.monotonically_increasing_id().alias("key"))
    keyed = stored(keyed, "repeated-rows")
    found = fingerprints(keyed.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")), shingle)
    found = found.select(F.col("doc_id").alias("key"), "fp").join(sized(named), "fp").drop("fp")
    least = keyed.select("key", F.col("row.doc_id").cast("long").alias("doc_id")).join(found, "key").where("doc_id <=> component_id")
    first = sized(stored(least.groupBy("root").agg(F.min("key").alias("key")).select("key"), "repeated-kept"))
    stay = keyed.join(first, "key", "left_semi")
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(stay.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
