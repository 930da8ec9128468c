"""Source divergence audit by in-mapper stripes.

A stripe belongs to a term of a language: the number of its documents and its count in every source. Each partition folds
whole documents into a hash of stripes and spills it as rows when it holds ``STRIPES`` counts. Spark shuffles the spilled
stripes by (lang, term) and sorts them; those of one key are merged by adding them up, one open stripe at a time. The empty term stands for the documents themselves: its stripe names every source of a language, also those
without a term. Merged stripes of terms in ``least`` documents or more are stored.

From them come V (terms of a language) and N (a source's count of all kept terms). Stripes are then dealt by language and
a hash of the term to buckets of about ``BUCKET`` terms, each beside the sources of its language, and directly emit the
divergences: a bucket's sum for each pair of sources, and its ten leading terms of each source. Sources are taken in blocks
of ``BLOCK`` against all, so a bucket's memory is bounded by BLOCK times the sources of a language. A language that holds most
rows has most buckets. All arithmetic is exact: shares by long division in 64-bit integers, three digits at a time.

A null text has no terms; null languages and sources are those of the empty string. Rows, also repeated ones and those
without an id, count one by one; other columns are ignored; an empty table gives no rows. Ties go by the item's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as tx
from .shared import stored

STRIPES = 1_000_000  # counts that a partition holds before it spills
MERGED = 20_000  # rows that are merged at once
BUCKET, BLOCK, CELLS = 2_000, 256, 2_000_000
SCALE, LEAST, TOP = 9, 10, 10  # digits of a share, documents of a term, terms of a report
_OUTSIDE = np.ones(256, dtype=bool)
_OUTSIDE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_COUNTS = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))
_STRIPE = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()), ("counts", _COUNTS)])
_VALUE = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


class Stripes:
    """The hash of a partition: documents and counts a source of every (lang, term), both numbered by dictionaries."""

    def __init__(self) -> None:
        self.names: tuple[dict[str, int], dict[str, int]] = ({}, {})  # of languages and of sources
        self.terms = pa.array([], pa.large_string())
        self.held: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def fold(self, rows: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> None:
        """Adds the documents of a slice."""
        data = tx.lowered(data)
        starts, ends, bounds = tx.words(data, off, _OUTSIDE)
        coded = tx.coded(data, starts, ends)
        lang, source = (self._numbers(rows.column(c).dictionary_encode(), k) for k, c in enumerate(("lang", "source")))
        width, sources = len(coded.dictionary) + 1, len(self.names[1])
        code = np.append(coded.indices.to_numpy().astype(np.int64), np.full(len(lang), width - 1))
        doc = np.append(tx.by_doc(bounds), np.arange(len(lang)))
        once = np.unique(doc * width + code)
        key, df = np.unique(lang[once // width] * width + once % width, return_counts=True)
        full, n = np.unique((lang[doc] * width + code) * sources + source[doc], return_counts=True)
        of = full // sources
        terms = pa.concat_arrays([coded.dictionary, pa.array([""], pa.large_string())])
        # source 0 stands for the documents
        self._add(terms, np.append(key // width, of // width), np.append(key % width, of % width), np.append(np.zeros(len(key), np.int64), full % sources + 1), np.append(df, n))

    def _numbers(self, coded: pa.DictionaryArray, kind: int) -> np.ndarray:
        names = self.names[kind]
        own = np.array([names.setdefault(x, len(names)) for x in coded.dictionary.to_pylist()], np.int64)
        return own[coded.indices.to_numpy()]

    def _add(self, terms: pa.Array, lang: np.ndarray, code: np.ndarray, source: np.ndarray, n: np.ndarray) -> None:
        self.held.append((terms, lang, code, source, n))
        self.size += len(n)

    def merge(self) -> None:
        """Adds up what the slices brought; ``size`` is the number of counts then."""
        if not self.held:
            return
        coded = pa.concat_arrays([h[0] for h in self.held]).dictionary_encode()
        number, at = coded.indices.to_numpy().astype(np.int64), 0
        codes = []
        for terms, _, code, _, _ in self.held:
            codes.append(number[at : at + len(terms)][code])
            at += len(terms)
        lang, source, n = (np.concatenate([h[k] for h in self.held]) for k in (1, 3, 4))
        width, sources = len(coded.dictionary), len(self.names[1]) + 1
        key = (lang * width + np.concatenate(codes)) * sources + source
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key, n = key[first], np.add.reduceat(n, first)
        self.held, self.size = [], 0
        self._add(coded.dictionary, key // sources // width, key // sources % width, key % sources, n)

    def spilled(self) -> Iterator[pa.RecordBatch]:
        """The stripes as rows; the hash is empty then."""
        self.merge()
        if not self.held:
            return
        (terms, lang, code, source, n), names = self.held[0], [pa.array(list(x), pa.string()) for x in self.names]
        self.__init__()
        heads = np.flatnonzero(source == 0)  # a stripe's entries lie together, the documents first
        ends = np.append(heads[1:], len(n))
        for lo in range(0, len(heads), 50_000):
            head, end = heads[lo : lo + 50_000], ends[lo : lo + 50_000]
            inner = np.ones(end[-1] - head[0], bool)
            inner[head - head[0]] = False
            inner = np.flatnonzero(inner) + head[0]
            counts = pa.StructArray.from_arrays([names[1].take(pa.array(source[inner] - 1)), pa.array(n[inner])], fields=list(_COUNTS.value_type))
            offset = np.concatenate([[0], np.cumsum(end - head - 1)])
            columns = [names[0].take(pa.array(lang[head])), terms.take(pa.array(code[head])).cast(pa.string()), pa.array(n[head]), pa.ListArray.from_arrays(pa.array(offset, pa.int32()), counts)]
            yield pa.RecordBatch.from_arrays(columns, schema=_STRIPE)


class Merger:
    """Adds up the sorted rows of equal (lang, term); keeps stripes of ``least`` documents and those of the empty term."""

    def __init__(self, least: int):
        self.least = least
        self.open: pa.Table | None = None  # the stripe that more rows may follow

    def add(self, rows: pa.Table, last: bool = False) -> pa.Table:
        rows = rows if self.open is None else pa.concat_tables([self.open, rows])
        rows = rows.combine_chunks()
        if not rows.num_rows:
            return rows
        lang, term = (rows.column(c).chunk(0) for c in ("lang", "term"))
        new = np.ones(len(lang), bool)
        for c in (lang, term):
            same = pc.equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            new[1:] = same if c is lang else ~(new[1:] & same)
        first = np.flatnonzero(new)
        df = np.add.reduceat(rows.column("df").chunk(0).to_numpy(), first)
        keep = (df >= self.least) | pc.equal(term.take(pa.array(first)), "").to_numpy(zero_copy_only=False)
        keep[-1] |= not last  # open: more rows may follow
        stripe = np.cumsum(new) - 1
        stripes = self._added(rows, np.flatnonzero(keep[stripe]), stripe, first[keep], df[keep])
        if last:
            return stripes
        self.open = stripes.slice(stripes.num_rows - 1)
        return stripes.slice(0, stripes.num_rows - 1)

    def _added(self, rows: pa.Table, taken: np.ndarray, stripe: np.ndarray, first: np.ndarray, df: np.ndarray) -> pa.Table:
        counts = rows.column("counts").chunk(0).take(pa.array(taken))
        sizes = pc.list_value_length(counts).to_numpy()
        entries = counts.flatten()
        coded = entries.field("source").dictionary_encode()
        number = np.unique(stripe[taken], return_inverse=True)[1]
        key = np.repeat(number, sizes) * max(1, len(coded.dictionary)) + coded.indices.to_numpy()
        order = np.argsort(key, kind="stable")
        key, n = key[order], entries.field("n").to_numpy()[order]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        key, n = key[at], np.add.reduceat(n, at) if len(at) else n
        of, source = np.divmod(key, max(1, len(coded.dictionary)))
        offset = np.searchsorted(of, np.arange(len(first) + 1))
        merged = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(source)), pa.array(n)], fields=list(_COUNTS.value_type))
        columns = [rows.column(c).chunk(0).take(pa.array(first)) for c in ("lang", "term")]
        return pa.Table.from_arrays([*columns, pa.array(df), pa.ListArray.from_arrays(pa.array(offset, pa.int32()), merged)], schema=_STRIPE)


def merged_stripes(docs: DataFrame, least: int = LEAST, limit: int = STRIPES, slice_bytes: int = tx.SLICE_BYTES) -> DataFrame:
    """lang, term, df, counts (source, n): every term in ``least`` documents of its language, and the empty term with a language's documents. Stored."""

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes = Stripes()
        for rows, data, off in tx.slices(batches, slice_bytes):
            stripes.fold(rows, data, off)
            if stripes.size >= 2 * limit:
                stripes.merge()
                if stripes.size >= limit:
                    yield from stripes.spilled()
        yield from stripes.spilled()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, held = Merger(least), []
        for rows in batches:
            held.append(rows)
            if sum(r.num_rows for r in held) >= MERGED:
                yield from merger.add(pa.Table.from_batches(held, _STRIPE)).to_batches()
                held = []
        yield from merger.add(pa.Table.from_batches(held, _STRIPE), last=True).to_batches()

    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    shape = "lang string, term string, df long, counts array<struct<source:string,n:long>>"
    dealt = docs.select(*columns).mapInArrow(folded, shape).repartition("lang", "term")
    # a hash as the first key: it decides most comparisons
    ordered = dealt.sortWithinPartitions(F.xxhash64("lang", "term"), "lang", "term")
    return stored(ordered.mapInArrow(merged, shape), "stripes")


def sources_of(stripes: DataFrame) -> DataFrame:
    """lang, v (its terms), n (their count), sources (source, n; ascending): one row a language, from its stored stripes."""
    entry = stripes.select("lang", "term", F.explode("counts").alias("e"))
    n = F.sum(F.when(F.col("term") != "", F.col("e.n")).otherwise(0))
    each = entry.groupBy("lang", F.col("e.source").alias("source")).agg(n.alias("n"))
    named = each.groupBy("lang").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("sources"))
    terms = stripes.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("v"))
    return named.join(terms, "lang")


def shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(10**SCALE * (count + 2) / whole), exact while whole is below 9 * 10**15."""
    rest = count + 2
    out, rest = rest // whole * 10**SCALE, rest % whole
    for digits in range(SCALE - 3, -1, -3):
        rest = rest * 1000
        out += rest // whole * 10**digits
        rest = rest % whole
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _emitted(bucket: int, block: int, width: int, left: pa.Table, right: pa.Table) -> pa.Table:
    """A bucket's stripes (lang, term, counts) beside its language (v, n, sources): for the sources of a block of ``width``, sums for pairs and leading terms."""
    if not right.num_rows or (not left.num_rows and bucket):
        return _VALUE.empty_table()
    lang = right.column("lang")[0].as_py()
    v, n = right.column("v")[0].as_py(), right.column("n")[0].as_py()
    sources = right.column("sources")[0].as_py()
    names = [s["source"] for s in sources]
    if block * width >= len(names):
        return _VALUE.empty_table()
    own = np.arange(block * width, min(len(names), (block + 1) * width))
    whole = np.array([s["n"] for s in sources], np.int64) + 2 * v
    place = {s: k for k, s in enumerate(names)}
    sums = np.zeros((len(own), len(names)), np.int64)
    terms = left.column("term").to_pylist()
    stripes = left.column("counts").to_pylist()
    step = max(1, CELLS // max(1, len(own) * len(names)))
    leading: list[list[tuple[int, bytes, str]]] = [[] for _ in own]
    for lo in range(0, len(terms), step):
        counts = np.zeros((min(step, len(terms) - lo), len(names)), np.int64)
        for row, stripe in zip(counts, stripes[lo : lo + step], strict=True):
            for e in stripe:
                row[place[e["source"]]] = e["n"]
        p = shares(counts, whole)
        sums += gap(p[:, own, None], p[:, None, :]).sum(axis=0)
        q = shares(counts.sum(axis=1), np.int64(n + 2 * v))[:, None]
        value = np.where((counts > 0) & (p > q), gap(p, q), -1)
        for k, s in enumerate(own):
            found = np.flatnonzero(value[:, s] >= 0)
            if len(found) > TOP:
                edge = np.partition(value[found, s], -TOP)[-TOP]
                found = found[value[found, s] >= edge]
            best = leading[k] + [(-int(value[t, s]), terms[lo + t].encode(), terms[lo + t]) for t in found]
            leading[k] = sorted(best)[:TOP]
    out = [(names[s], "pair", names[o], int(sums[k, o])) for k, s in enumerate(own) for o in range(len(names)) if o != s]
    out += [(names[s], "term", term, -value) for k, s in enumerate(own) for value, _, term in leading[k]]
    columns = list(zip(*out, strict=True)) or [[]] * 4
    return pa.Table.from_arrays([pa.array([lang] * len(out), pa.string()), *(pa.array(list(c), t) for c, t in zip(columns, _VALUE.types[1:], strict=True))], schema=_VALUE)


def audit(docs: DataFrame, least: int = LEAST, bucket_terms: int = BUCKET, width: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: for every source its divergence from each other one of its language (``pair``), and the ``TOP`` terms it has more of than its language (``term``)."""
    stripes = merged_stripes(docs, least)
    langs = stored(sources_of(stripes), "sources")
    buckets = stripes.count() // bucket_terms + 1
    blocks = ((langs.agg(F.max(F.size("sources"))).first()[0] or 1) - 1) // width + 1
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket")
    left = stripes.where(F.col("term") != "").select("lang", "term", "counts", bucket, each_block)
    right = langs.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long")))).select("*", each_block)
    by = ("lang", "bucket", "block")

    def emitted(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _emitted(key[1].as_py(), key[2].as_py(), width, left, right)

    values = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(emitted, "lang string, source string, part string, item string, value long")
    added = values.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return added.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= TOP))
