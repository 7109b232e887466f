"""Ids of blank-separated strings that go to the tokenizers library many at once."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from stagewise.llm import packing


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.fixture
def words():
    return packing.WordIds(packing.vocabulary_path("word_bpe_49k.json"), remembered=50)


def test_ids_equal_the_library(words):
    draw = random.Random(7)
    signs = ["a", "Word", "Été", "'s", "don't", "12", ",***", " ", "  ", "\n", "\t", "\x01", " \x01 ", "\x1c", " ", "́",
             "J̌", "İ", "Σ", "中", "\U0001f600", "<|endoftext|>", "<|startoftext|>", "\x00", "≠", "x" * 300]
    texts = [None, "", " ", "\x01", "a \x01 b"] + ["".join(draw.choices(signs, k=draw.randint(1, 30))) for _ in range(600)]
    tok = words._tokenizer
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    for size in (1, 7, 605, 605):  # remembered strings, too
        got = [np.frombuffer(r, "<u4").tolist() for k in range(0, len(texts), size) for r in words.encode_all(pa.array(texts).slice(k, size))]
        assert got == want
    assert list(words.encode_all(pa.array([], pa.string()))) == []


def test_strings_go_to_the_library_in_few_texts(words):
    words._tokenizer = counted = Counted(words._tokenizer)
    texts = pa.array([" ".join(f"w{100 * k + j}" for j in range(100)) for k in range(50)])
    first = list(words.encode_all(texts))
    assert counted.texts <= 50
    assert list(words.encode_all(texts)) == first and counted.texts <= 50
