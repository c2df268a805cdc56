"""Unbroken words far beyond LONG_WORD: both tokenizers against the libraries, and every way in which windows are joined."""

import random
import string

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from shelfwise.llm import _bpe, pieces, token_counts

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")


def words(n):
    rng = random.Random(5)
    parts = ["the", "internation", "alization", "of", "data", "re", "cogn", "ition", "s", "ing"]
    return {
        "letters": "".join(rng.choices(string.ascii_lowercase, k=n)),
        "syllables": "".join(rng.choices(parts, k=n // 4)),
        "base64": "".join(rng.choices(string.ascii_letters + string.digits + "+/", k=n)),
        "one letter": "a" * n,
        "two letters": "ab" * (n // 2),
        "signs": "".join(rng.choices("=-_#*", k=n)),
        "chinese": "".join(chr(rng.randrange(0x4E00, 0x6000)) for _ in range(n // 3)),
        "accents": "".join(rng.choices("aeéèüöñß", k=n // 2)),
    }


@pytest.fixture(scope="module")
def counter():
    return token_counts.WordTokenizer(WORD_FILE), tokenizers.Tokenizer.from_file(WORD_FILE)


@pytest.fixture(scope="module")
def encoder():
    return pieces.PieceTokenizer(PIECE_FILE), sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)


@pytest.mark.parametrize("window, slack", [(_bpe.WINDOW, _bpe.SLACK), (40, 0)])
@pytest.mark.parametrize("name", words(1))
def test_long_words_count_as_the_library(counter, monkeypatch, name, window, slack):
    monkeypatch.setattr(_bpe, "WINDOW", window)
    monkeypatch.setattr(_bpe, "SLACK", slack)
    own, library = counter
    own.forget()
    texts = [words(12_000)[name], "before " + words(1_000)[name] + " after", words(_bpe.LONG_WORD + 1)[name], "a b"]
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert token_counts.count_texts(own, texts).tolist() == want


@pytest.mark.parametrize("window, slack", [(_bpe.WINDOW, _bpe.SLACK), (40, 0)])
@pytest.mark.parametrize("name", words(1))
def test_long_words_encode_as_the_library(encoder, monkeypatch, name, window, slack):
    monkeypatch.setattr(_bpe, "WINDOW", window)
    monkeypatch.setattr(_bpe, "SLACK", slack)
    own, library = encoder
    own.forget()
    texts = [words(12_000)[name], "before " + words(1_000)[name] + " after", words(_bpe.LONG_WORD + 1)[name], "a b"]
    ids, bounds = own.encode(texts)
    for i, t in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode(t)


def test_windows_of_several_groups(counter, monkeypatch):
    """More windows than one group holds: the groups join as windows do."""
    monkeypatch.setattr(_bpe, "WINDOWS_AT_ONCE", 3)
    own, library = counter
    for text in words(9_000).values():
        own.forget()
        assert token_counts.count_texts(own, [text]).tolist() == [len(library.encode(text, add_special_tokens=False).ids)]


def test_every_prefix_of_a_long_word(counter):
    own, library = counter
    word = words(900)["letters"]
    counts = own.prefixes(word.encode(), np.array([0]), np.array([len(word)]), every=True)[1]
    for n in (1, 2, 399, 400, 401, 655, 656, 657, 899, 900):
        assert counts[n - 1] == len(library.encode(word[:n], add_special_tokens=False).ids)


def test_stored_ids_are_bounded(encoder, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_IDS", 500)
    own, library = encoder
    own.forget()
    for seed in range(4):
        text = " ".join("".join(random.Random(seed * 100 + i).choices(string.ascii_lowercase, k=9)) for i in range(300))
        ids, _ = own.encode([text])
        assert ids.tolist() == library.encode(text)
        before = len(own.known_ids)
        own.encode(["x"])
        assert len(own.known_ids) < before
