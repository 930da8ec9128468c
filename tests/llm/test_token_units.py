"""Units go through the tokenizers library many at a time, with the ids that each has alone."""

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from anchorwise.llm import queries, text, tokens


@pytest.fixture
def path():
    return P.path(queries.BPE_50K)


def _odd_texts():
    rnd = np.random.default_rng(5)
    alphabet = list("ab1.' \n\t\r") + [" ", " ", "é", "日", "\u0085", "\x1c", "в", "\xa0", "　", "😀", "'s", "<|endoftext|>", "_"]
    return ["".join(rnd.choice(alphabet, n)) for n in rnd.integers(0, 40, 1500)] + [None, "", " ", "\n", "x" * 5000, " y" * 3000]


@pytest.mark.parametrize("chunk", [1, 50, tokens.CHUNK])
@pytest.mark.parametrize("cache", [10, tokens.CACHE])
def test_ids_are_the_librarys(path, monkeypatch, chunk, cache):
    monkeypatch.setattr(tokens, "CHUNK", chunk)
    monkeypatch.setattr(tokens, "CACHE", cache)
    units, texts = tokens.Units(path), _odd_texts()
    for lo in (0, 400, 400, 900):  # some units are known by then
        part = texts[lo : lo + 700]
        flat, bounds = units.encode(*text.raw(pa.array(part, pa.string())))
        got = [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [units.tokenizer.encode(t or "", add_special_tokens=False).ids for t in part]
    for part in ([], [None, ""]):
        flat, bounds = units.encode(*text.raw(pa.array(part, pa.string())))
        assert not len(flat) and bounds.tolist() == [0] * (len(part) + 1)


class Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **how):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **how)


def test_few_texts_for_many_units(path):
    units = tokens.Units(path)
    units.tokenizer = Counting(units.tokenizer)
    many = " ".join(f"word{k}" for k in range(20_000))
    for _ in range(2):
        units.encode(*text.raw(pa.array([many])))
    assert 0 < units.tokenizer.texts < 20
