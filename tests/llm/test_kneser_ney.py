"""Tokens of the language model told apart many at a time, and its sorts, against the plain ways."""

import numpy as np
import pytest
import xxhash

from laneforge.llm import kneser_ney

TEXTS = [b"", b" \t\n\x0b\x0c\r ", b"one", b"One  ONE\xc3\x89 one\x00 one", b"\x85\x1c\xa0 x" * 40, "Ünï größe 日本 ".encode() * 30, b"a b c " * 500, b"no end"]


def plain(texts):
    words = [w for t in texts for w in kneser_ney.tokens(t)]
    return [xxhash.xxh64_intdigest(w) for w in words], [len(kneser_ney.tokens(t)) for t in texts]


@pytest.mark.parametrize("texts", [TEXTS, [b""], [b"", b""], TEXTS[::-1], [b"w" * (3 * kneser_ney.PIECE_BYTES), b"x y"]])
def test_tokens_told_apart_at_once_have_their_own_hashes(texts):
    own, lengths = kneser_ney.hashes_of(texts)
    assert (own.tolist(), lengths.tolist()) == plain(texts)


def test_words_of_one_polynomial_stay_apart(monkeypatch):
    """With equal weights all words of a length and place meet, and the check by byte tells them apart."""
    monkeypatch.setattr(kneser_ney, "BYTES", np.zeros(256, np.uint64))
    own, lengths = kneser_ney.hashes_of(TEXTS)
    assert (own.tolist(), lengths.tolist()) == plain(TEXTS)


def test_each_distinct_word_is_hashed_once(monkeypatch):
    hashed, real = [], xxhash.xxh64_intdigest
    monkeypatch.setattr(kneser_ney.xxhash, "xxh64_intdigest", lambda w, *seed: (hashed.append(w), real(w, *seed))[1])
    kneser_ney.hashes_of([b"to be or not to be"] * 100)
    assert sorted(hashed) == sorted([kneser_ney.END, b"to", b"be", b"or", b"not"])


@pytest.mark.parametrize("high", [3, 1 << 20, 1 << 63])
def test_orders_and_distinct_values(high):
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, high, 3000, np.int64).astype(np.uint64) for _ in range(2))
    a[::7], b[::5] = kneser_ney.BEGIN << np.uint64(32), kneser_ney.LOW
    assert (kneser_ney.order_of(a) == np.argsort(a, kind="stable")).all()
    assert (kneser_ney.order_of(a, b.astype(np.uint32)) == np.lexsort([b.astype(np.uint32), a])).all()
    values, back, first = kneser_ney.distinct(a, True)
    assert (values == np.unique(a)).all() and (values[back] == a).all() and (a[first] == values).all()
    numbers = b.astype(np.uint32).astype(np.int64) - 1
    values, back = kneser_ney.distinct_numbers(numbers)
    assert (values == np.unique(numbers)).all() and (values[back] == numbers).all()
