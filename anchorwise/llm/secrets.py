"""Secret scans: patterns, and a token-efficiency test for random strings.

Prose has many characters to a token of a public vocabulary, random strings few. Runs of at least ``MIN_CHARS``
characters of ``[A-Za-z0-9+/=_-]`` outside the pattern spans are encoded with tiktoken; those with less than
``MAX_RATIO`` characters a token are reported as kind ``random``. Only known digests (hexadecimal strings of a digest's
length), UUIDs, numbers, runs without a letter and repeats of one character are left out before. Of the others, a run is a name
only if words of the vocabulary, of ``WORD_CHARS`` letters a token or more, make up at least half of it. Where a pattern span
lies in a run, what is left of the run beside it is tested; a run that isn't reported whole is tested again part by part
between ``/ = _ -``, since the words of a path may outvote a random part.

Null texts count as empty and have no span. Rows are kept one for one; an empty table gives no rows; other columns
pass through ``redact`` and are ignored by ``scan``.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
#: What a text with an assign match has in lower case; a text without any is not searched.
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # leftmost runs of 32 or more are the long ones among all runs
MIN_VALUE, MIN_ACCESS = 8, 16
MIN_CHARS, MAX_RATIO = 20, 2.0
RUN = re.compile(r"[A-Za-z0-9+/=_-]{%d,}" % MIN_CHARS)
PART = re.compile(r"[A-Za-z0-9+]{%d,}" % MIN_CHARS)
DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})\Z")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
NUMBER = re.compile(r"[0-9+/=_-]+(?:[eE][+-]?[0-9]+)?\Z")
WORD_CHARS = 4
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")  # no part of a run is read twice
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, spans array<struct<kind:string,start:int,end:int>>"


def encoder(path: str, pattern: str):
    """A worker's tiktoken encoder."""

    def make():
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return tx.warm(("secrets", path, pattern), make)


def known(run: str) -> bool:
    """A known digest, a number or a rule of one character."""
    return bool(DIGEST.match(run) or UUID.match(run) or NUMBER.match(run)) or len(set(run)) == 1


def name(run: str, encode) -> bool:
    """At least half of the run is in words of few tokens, as they stand or as they begin in prose."""
    words = [w for w in WORD.findall(run) if len(w) >= WORD_CHARS]
    if 2 * sum(map(len, words)) < len(run):
        return False
    return 2 * sum(len(w) for w in words if WORD_CHARS * min(len(encode(w)), len(encode(" " + w.lower()))) <= len(w)) >= len(run)


def beside(a: int, b: int, base: list[tuple[int, int, int]], text: str) -> list[tuple[int, int]]:
    """What the spans of ``base`` (ascending) leave of text[a:b], without separators at its ends; all of it if none touches it."""
    touching = [(s, e) for s, _, e in base if s < b and a < e]
    if not touching:
        return [(a, b)]
    left, at = [], a
    for s, e in [*touching, (b, b)]:
        part = text[at:s] if s > at else ""
        begin = at + len(part) - len(part.lstrip("/=_-"))
        end = at + len(part.rstrip("/_-"))
        if end - begin >= MIN_CHARS:
            left.append((begin, end))
        at = max(at, e)
    return left


def random_parts(a: int, b: int, text: str, encode) -> list[tuple[int, int]]:
    """The whole of text[a:b], or its parts between separators, where they are random strings."""

    def random(run: str) -> bool:
        return not known(run) and len(run) < MAX_RATIO * len(encode(run)) and not name(run, encode)

    run = text[a:b]
    if random(run):
        return [(a, b)]
    parts = [(a + m.start(), a + m.end()) for m in PART.finditer(run)]
    return [] if known(run) or parts == [(a, b)] else [(s, e) for s, e in parts if random(text[s:e])]


def spans(text: str, encode) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order; the random runs overlap no other span."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    runs = [m.span() for m in RUN.finditer(text)]
    if runs:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        base = sorted(found)
        starts, longest = [s for s, _, _ in base], max((e - s for s, _, e in base), default=0)
        for a, b in runs:
            near = base[bisect_left(starts, a - longest) : bisect_left(starts, b)]
            for s, e in beside(a, b, near, text):
                found += [(x, 3, y) for x, y in random_parts(s, e, text, encode)]
    return sorted(found)


def scan(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, counts by kind and all spans (code points, end exclusive) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode_ordinary
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for rows in batches:
            found = [spans(t.as_py() or "", encode) for t in rows.column("text")]
            counts = [pa.array([sum(k == n for _, k, _ in f) for f in found], pa.int64()) for n in range(4)]
            listed = pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in f] for f in found], pa.list_(kind))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *counts, listed], ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "spans"])

    tx.small_batches(docs.sparkSession)
    return tx.keyed(docs).mapInArrow(run, SCHEMA)


def redact(docs: DataFrame, path: str, pattern: str, mask: str = "<secret>") -> DataFrame:
    """The same rows and columns with every span of ``text`` replaced by the mask; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode_ordinary
        for rows in batches:
            out = []
            for t in rows.column("text"):
                text = t.as_py()
                at, parts = 0, []
                for a, _, b in spans(text or "", encode):
                    if a >= at:
                        parts += [text[at:a], mask]
                    at = max(at, b)
                out.append(text if not at else "".join([*parts, text[at:]]))
            at = rows.schema.get_field_index("text")
            yield rows.set_column(at, rows.schema.field(at), pa.array(out, rows.schema.field(at).type))

    tx.small_batches(docs.sparkSession)
    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.withColumn("text", F.col("text").cast("string")).schema)


def joined(kinds: tuple[str, ...] = KINDS):
    """The spans of these kinds as kind:start:end, comma-joined."""
    chosen = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
