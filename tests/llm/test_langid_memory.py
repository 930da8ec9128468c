"""Scoring words in smaller stretches gives the same scores and holds less at once."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("regex")

from anchorwise.llm import langid as L


def _scored(words, p, trie, cells):
    tracemalloc.start()
    got = np.concatenate([L.Lattice(words[lo:hi], trie).log_probability(p) for lo, hi in L.groups(words, cells)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return got, peak


def test_smaller_stretches_score_alike_in_less_memory():
    rng = random.Random(3)
    words = sorted(("".join(rng.choices("abcdefgh", k=rng.randint(1, 24))) for _ in range(12_000)), key=len)
    pieces = {w: i + 1 for i, w in enumerate(sorted({w[:k] for w in words[:3000] for k in (1, 2, 3, 4)}))}
    p = np.random.default_rng(3).dirichlet(np.ones(len(pieces) + 1), 4).T.copy()
    trie = L.Trie(pieces)
    whole, most = _scored(words, p, trie, L.CELLS)
    parts, less = _scored(words, p, trie, L.SCORED_CELLS)
    print("peak MB", most / 1e6, less / 1e6)
    assert np.array_equal(whole, parts)
    assert less < 0.5 * most


def _worker(monkeypatch, spark, model):
    """What predict runs in a worker."""
    held, docs = [], spark.createDataFrame([(1, "a")], "doc_id long, text string")
    real = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a, **k: held.append(f) or real(self, f, *a, **k))
    L.predict(docs, model)
    return held[0]


def test_a_worker_holds_little(spark, monkeypatch):
    """12 MB of texts with many new words: a slice's arrays and the words met, not four times as much."""
    import public_tokenizers

    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(300)) for _ in range(6000)]
    path = public_tokenizers.path("piece_bpe_32k.model")
    p = np.random.default_rng(5).dirichlet(np.ones(len(L._rows(path)) + 1), 2).T.copy()
    run = _worker(monkeypatch, spark, L.Model(path, ["x", "y"], p))
    batches = [pa.RecordBatch.from_pydict({"doc_id": range(lo, lo + 1000), "text": texts[lo : lo + 1000]}) for lo in range(0, 6000, 1000)]
    L.vocabulary(path)
    monkeypatch.setattr(L.Lattice, "log_probability", lambda self, p: np.zeros((self.n, p.shape[1])))  # measured above
    tracemalloc.start()
    n = sum(b.num_rows for b in run(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print("peak MB", peak / 1e6)
    assert n == 6000 and peak < 150e6


def test_runs_of_a_word_add_up():
    pieces = {c: i + 1 for i, c in enumerate("abc")} | {"▁a": 4}
    p = np.random.default_rng(1).dirichlet(np.ones(5), 3).T.copy()
    trie, known = L.Trie(pieces), L.Known(3)
    known.score({"▁a", "bc"}, trie, p)
    known.score({"bc", "cab", "b"}, trie, p)
    one = {w: L.Lattice([w], trie).log_probability(p)[0] for w in ("▁a", "bc", "cab", "b")}
    got = known.total([["▁a"], [], ["▁a", "bc", "bc"], ["cab", "b"]])
    assert np.array_equal(got, [one["▁a"], np.zeros(3), one["▁a"] + one["bc"] + one["bc"], one["cab"] + one["b"]])


def test_the_pipeline_sends_a_text_once(spark, monkeypatch):
    import corpus_pipeline

    sent = []
    real = L.predict
    monkeypatch.setattr(L, "predict", lambda docs, model: sent.append(docs.schema) or real(docs, model))
    docs = spark.createDataFrame([(1, "ein Wort", "de", None), (2, None, "en", "s")], "doc_id long, text string, lang string, score string")
    got = corpus_pipeline.language(spark, docs, "")
    assert got.schema.simpleString() == docs.schema.simpleString() and "text" not in sent[0]["row"].dataType.names
    assert set(got.collect()) <= set(docs.collect())
