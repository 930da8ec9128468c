"""Encoding through the table of distinct marked words against the sentencepiece library."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest

from anchorwise.llm import queries, sentencepieces, text

from .conftest import table

PATH = P.path(queries.PIECES)
MIXED = [*"abcdefghij      \n\t.,;'\"1234ABCÉéñß日本語▁🙂\x00ﬁ①в", "the", "ing", " a", "  ", "<s>", "</s>", "<unk>", "<0x41>"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_query_is_the_library(spark, folder, library):
    want = Counter()
    for i, t in table(spark, folder):
        ids = library.encode(t or "")
        want[i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))] += 1
    assert Counter(map(tuple, queries.op12_sentencepiece(spark, folder).collect())) == want


@pytest.mark.parametrize("known", [0, 50, 10_000])
def test_small_slices_and_tables(spark, edge, library, known):
    """A text longer than a slice, and frequent chunks that are known from the slice before, or forgotten."""
    got = sentencepieces.encode(queries.documents(spark, edge), PATH, slice_bytes=3000, known=known).collect()
    assert Counter((i, tuple(x)) for i, x in got) == Counter((i, tuple(library.encode(t or ""))) for i, t in table(spark, edge))


def test_a_known_chunk_is_not_segmented_again():
    own, seen = sentencepieces.Table(PATH), []
    segment = own.pieces.segment
    own.pieces.segment = lambda found: (seen.extend(found.to_pylist()), segment(found))[1]
    for texts in (["x y x", "y z"], ["z x y", "y"]):
        own.encode(*text.raw(sentencepieces.marked(pa.array(texts))))
    assert seen == [" x", " y", " z", " z"]


def test_empty_table(spark, empty):
    assert queries.op12_sentencepiece(spark, empty).collect() == []


def test_mixed_texts(library):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(MIXED) for _ in range(rnd.randint(0, 150))) for _ in range(2000)]
    texts += ["", " ", "  ", "▁", "▁▁x", " " * 50, "\n" * 60, "w" * 3000, "ab" * 700]
    flat, bounds = sentencepieces.Table(PATH).encode(*text.raw(sentencepieces.marked(pa.array(texts))))
    want = library.encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    assert sentencepieces.Decoder(PATH).decode(flat, bounds).to_pylist() == library.decode(want)


def test_decoding_of_any_ids(library):
    rnd = random.Random(6)
    ids = [[rnd.randrange(32000) if rnd.random() < 0.5 else rnd.randrange(0, 262) for _ in range(rnd.randint(0, 10))] for _ in range(3000)]
    bounds = np.append(0, np.cumsum([len(x) for x in ids]))
    got = sentencepieces.Decoder(PATH).decode(np.array([i for x in ids for i in x]), bounds).to_pylist()
    assert got == [library.decode(x) for x in ids]
