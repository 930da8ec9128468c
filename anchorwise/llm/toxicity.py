"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's logit is a bias plus the weights of its words' features (the word and
its first letters, hashed); a document's score is the noisy-or of its sentences' probabilities, 1 - prod(1 - p).
Only document labels train it: the gradient of the document's loss reaches every sentence in proportion to what it
adds, so the fitted weights also locate the offending sentences.

The fit takes a bounded sample of labelled rows: at most ``max_docs`` of each label in expectation, by a hash of the
id, and at most ``max_bytes`` of text, one row an id. Gradients are summed on the driver over that sample; the model is one array of ``2 ** BITS`` weights.

Sentences end with a line feed or a word that ends in ``.!?``; a text without words has no sentence and score 0.
Null texts count as empty; null labels are left out; a table without both labels gives a model of score 0 for all.
Repeated rows each get their score; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import sized, stored

BITS = 18
PREFIXES = (3, 4, 5)
MAX_DOCS = 2500  # of each label
MAX_BYTES = 64 << 20  # of the sample's texts
ROUNDS, RATE, DECAY = 120, 0.1, 3e-4
LEAST_DOCS = 10  # that have a feature; a fiftieth of a small sample
START = -6.0  # bias before the fit: a sentence is rarely toxic
_ROWS: dict[str, np.ndarray] = {}


def features(word: str) -> np.ndarray:
    """Hashed features of a word: its letters, and its first letters if it is longer."""
    got = _ROWS.get(word)
    if got is None:
        if len(_ROWS) > 300_000:
            _ROWS.clear()
        key = tx.letters(word)
        names = [key, *[f"^{key[:n]}" for n in PREFIXES if len(key) > n]] if key else []
        got = _ROWS[word] = np.array([zlib.crc32(n.encode()) >> (32 - BITS) for n in names], np.int64)
    return got


def sentences(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word codes, feature rows of the distinct words (flat, with bounds), sentence of every word, and per sentence: first word, document."""
    starts, ends, bounds = tx.words(data, off)
    codes, distinct = tx.codes(data, starts, ends)
    rows = [features(w) for w in distinct]
    lens = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    if not len(starts):
        return codes, flat, lens, starts, starts, starts
    last = np.isin(data[ends - 1], np.frombuffer(b".!?", np.uint8))
    lines = np.cumsum(data == 10)
    new = np.empty(len(starts), bool)
    new[0] = True
    new[1:] = last[:-1] | (lines[starts[1:]] != lines[starts[:-1]])
    new[bounds[:-1][bounds[:-1] < len(starts)]] = True
    first = np.flatnonzero(new)
    return codes, flat, lens, np.cumsum(new) - 1, first, np.searchsorted(bounds, first, side="right") - 1


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def logits(self, codes, flat, lens, of, n: int) -> np.ndarray:
        """Of every sentence."""
        word = np.bincount(np.repeat(np.arange(len(lens)), lens), weights=self.weights[flat], minlength=len(lens))
        return self.bias + np.bincount(of, weights=word[codes], minlength=n)


def gradient(model: Model, parts: tuple, labels: np.ndarray, weigh: np.ndarray) -> tuple[np.ndarray, float]:
    """Of minus the weighted noisy-or log-likelihood, by the weights and by the bias; ``parts`` are those of ``sentences``."""
    codes, flat, lens, of, first, doc = parts
    p = 1 / (1 + np.exp(-np.clip(model.logits(codes, flat, lens, of, len(first)), -30, 30)))
    none = np.exp(np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(labels)))  # prod(1 - p)
    # of the log-likelihood by log prod(1 - p): 1 for a clean document, - prod / (1 - prod) for a toxic one
    by_clean = weigh * np.where(labels == 1, -none / np.maximum(1 - none, 1e-9), 1.0)
    g = by_clean[doc] * p  # minus the derivative of log(1 - p) by the logit is p
    word = np.bincount(codes, weights=g[of], minlength=len(lens))
    feature_of = np.repeat(np.arange(len(lens)), lens)
    return np.bincount(flat, weights=word[feature_of], minlength=1 << BITS), float(g.sum())


def _fit(data: np.ndarray, off: np.ndarray, labels: np.ndarray) -> Model:
    """Adam on the noisy-or likelihood; both labels weigh the same."""
    model = Model(np.zeros(1 << BITS), START)
    if not len(labels) or labels.min() == labels.max():
        return Model(model.weights, -np.inf)
    codes, flat, lens, of, first, doc = sentences(data, off)
    feature_of = np.repeat(np.arange(len(lens)), lens)
    in_docs = np.unique(doc[of] * len(lens) + codes) % len(lens)  # a distinct word once for each document
    n_docs = np.bincount(flat, weights=np.bincount(in_docs, minlength=len(lens))[feature_of], minlength=1 << BITS)
    live = n_docs >= min(LEAST_DOCS, max(2, len(labels) // 50))
    weigh = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    m, v, mb, vb = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0
    for t in range(1, ROUNDS + 1):
        by_weight, bias = gradient(model, (codes, flat, lens, of, first, doc), labels, weigh)
        grad = np.where(live, by_weight + DECAY * model.weights, 0.0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * bias, 0.999 * vb + 0.001 * bias * bias
        model.weights -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        model.bias -= RATE * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES) -> Model:
    """Learns from documents whose ``toxic`` label is 0 or 1; labels that repeat an id count once, as their greatest, and
    so do rows of ``docs`` that repeat one. The sample is bounded twice: by ``max_docs`` of each label, in expectation,
    and by ``max_bytes`` of text: documents are taken from the shortest on while they fit."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("toxic") == label, min(1.0, max_docs / n)).otherwise(share)
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < share * (1 << 20))
    rows = tx.keyed(docs).join(sized(stored(chosen, "toxicity-sample")), "doc_id")
    one = stored(rows.groupBy("doc_id", "toxic").agg(F.max("text").alias("text")), "toxicity-texts")
    sizes = sorted((r["n"] or 0, r["doc_id"]) for r in one.select("doc_id", F.octet_length("text").alias("n")).collect())
    fit_in = sum(total <= max_bytes for total in accumulate(n for n, _ in sizes))
    if fit_in < len(sizes):
        n, (most, last) = F.coalesce(F.octet_length("text"), F.lit(0)), sizes[fit_in]
        one = one.where((n < most) | ((n == most) & (F.col("doc_id") < last)))
    # the table is a bounded sample: its rows are sorted, so that the fit doesn't depend on their order
    sample = one.toArrow().sort_by("doc_id").combine_chunks()
    if not sample.num_rows:
        return Model(np.zeros(1 << BITS), -np.inf)
    rows = sample.to_batches()[0]
    return _fit(*tx.raw(rows.column("text")), rows.column("toxic").to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, at: float = 0.5) -> DataFrame:
    """doc_id, score, and the sentences whose own probability reaches ``at``: first word, words and probability."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        model = Model(weights, bias)
        found_type = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("p", pa.float64())]))
        for rows, data, off in tx.slices(batches):
            n = rows.num_rows
            codes, flat, lens, of, first, doc = sentences(data, off)
            p = 1 / (1 + np.exp(-np.clip(model.logits(codes, flat, lens, of, len(first)), -30, 30)))
            scores = -np.expm1(np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)) if bias > -np.inf else np.zeros(n)
            begin = first[np.searchsorted(doc, np.arange(n))[doc]] if len(doc) else first
            n_words = np.diff(np.append(first, len(of)))
            found: list[list[dict]] = [[] for _ in range(n)]
            for s in np.flatnonzero((p >= at) & (bias > -np.inf)):
                found[doc[s]].append({"first_word": int(first[s] - begin[s]), "n_words": int(n_words[s]), "p": float(p[s])})
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.clip(scores, 0.0, 1.0)), pa.array(found, found_type)], ["doc_id", "score", "offending"])

    tx.small_batches(docs.sparkSession)
    return tx.keyed(docs).mapInArrow(run, "doc_id long, score double, offending array<struct<first_word:int,n_words:int,p:double>>")
