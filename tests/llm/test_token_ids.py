"""Ids of the token files against those of the tokenizer for whole texts."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablex.llm import rangecoder, token_files
from tablex.llm.token_files import Encoder

MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def differing(name, texts):
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        encoder = Encoder(f.read())
    got = [np.frombuffer(b, "<u2").tolist() for b in encoder.texts([t.encode() for t in texts])]
    return [t for t, ids in zip(texts, got) if ids != tokenizer.encode(t, add_special_tokens=False).ids]


def test_every_latin_letter_before_every_mark():
    letters = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250))]
    assert differing("word_bpe_49k.json", [f"{w}{c}{m}" for c in letters for m in MARKS for w in ("", "ab")]) == []


def test_the_letter_that_becomes_two():
    assert differing("word_bpe_49k.json", ["TÜRKİYE CUMHURİYETİ.", "İ.", "İ", "aİ,b", "İİ!?", "cİ x"]) == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_random_texts_of_many_scripts(name):
    """The second vocabulary tells cases apart and lets tokens begin with a blank."""
    rng = random.Random(name)
    letters = "aBcZéÉİıßǅΑσς" "жЖあ漢글عा́½٣²ﬁＡ😀" "\u0085 ​" + MARKS + "  \t\n\r\v\f0123"
    texts = ["".join(rng.choices(letters, k=rng.randrange(1, 25))) for _ in range(4000)]
    texts += [" ".join(rng.choices(["The", "the", "THE", "word,", "İ.", "It's", "x=1;", "Ünder", "don't", "…", "100%"], k=30)) for _ in range(300)]
    assert differing(name, texts) == []


def test_texts_without_words():
    assert differing("word_bpe_49k.json", ["", " ", "\n\t\v"]) == []


def test_words_met_again_after_the_cache_was_renewed(monkeypatch):
    """Words move between two generations, and chunks that are no words are forgotten."""
    monkeypatch.setattr(token_files, "WORDS", 8)
    monkeypatch.setattr(token_files, "CHUNKS", 2)
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        encoder = Encoder(f.read())
    rng = random.Random(5)
    for _ in range(30):
        texts = [" ".join(rng.choices(["The", "the,", "ÜBER", "Über!", "über", "naïve).", "a1", "x-y", "...", "it's", "日本", "one", "Two;", "three"], k=9)) for _ in range(4)]
        assert [np.frombuffer(b, "<u2").tolist() for b in encoder.texts([None, *(t.encode() for t in texts)])] == [[], *(tokenizer.encode(t, add_special_tokens=False).ids for t in texts)]


def test_blocks_cost_about_the_order_0_of_their_ids():
    """Ids drawn at random cost what their own distribution says; every id is one step of the coder."""
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.4, 256 * 1024), 60000)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    coded = rangecoder.encode(ids.reshape(256, 1024))
    assert (rangecoder.decode(coded, 1024) == ids.reshape(256, 1024)).all()
    assert 8 * sum(map(len, coded)) < -1.2 * (share * np.log2(share)).sum() * len(ids)


@pytest.mark.parametrize("n", [1, 2, 1023, 1024, 1025, 5000])
def test_frames_of_any_length(n):
    ids = np.random.default_rng(n).integers(3, 49000, n).astype("<u2")
    (docs, back), = token_files.frames(token_files.frame([(7, ids[: n // 2].tobytes()), (None, ids[n // 2 :].tobytes())]) + b"\n")
    assert docs == [(7, n // 2), (None, n - n // 2)] and back.tolist() == ids.tolist()


def test_frames_of_more_blocks_than_lanes(monkeypatch):
    monkeypatch.setattr(rangecoder, "LANES", 4)
    ids = np.arange(9 * 1024 + 5, dtype="<u2")
    (docs, back), = token_files.frames(token_files.frame([(1, ids.tobytes())]) + b"\n")
    assert back.tolist() == ids.tolist() and [*token_files.together(10)] == [(0, 5), (5, 10)] and [*token_files.together(1)] == [(0, 1)]


def test_every_id_of_16_bits_in_one_distribution():
    ids = np.random.default_rng(3).permutation(1 << 16).reshape(64, 1024)
    assert (rangecoder.decode(rangecoder.encode(ids), 1024) == ids).all()
