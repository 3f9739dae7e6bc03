"""The remembering encoder against the library on whole texts."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from codeloom.llm import tokens

ALPHABET = [
    "Ä", "ÿ", "Ōž", "ß", "Ÿ", "İ", "ŉ", "ĳ", "ſ", "×", "ª", "a", "B", "'s", "'", "é", "é", "Σ", "ς", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "　",
    " ", " ", " ", "1", "23", "!", "...", "<|endoftext|>", "<|startoftext|>", "中", "\U0001f600", "ﬁ", "İ",
    "ͅ", "\x00", "​", "﻿", "I'LL", "word", "x" * 70,
]


@pytest.mark.parametrize("name", list(tokens.STRETCHES))
def test_ids_equal_the_library(spark, sf, name, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 500)
    monkeypatch.setattr(tokens, "REMEMBERED_WORDS", 300)
    coder = tokens.Encoder(tokens.path(name))
    library = Tokenizer.from_file(tokens.path(name))
    draw = random.Random(8)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randrange(14))) for _ in range(8000)]
    texts += ["".join(draw.choice("ab'stlmdrvIeLL. 0 1~!@- \n\t\ré") for _ in range(draw.randrange(40))) for _ in range(8000)]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(50).collect()]
    want = [np.array(x.ids, "<u2").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]
    assert list(coder.encode(texts)) == want
    assert list(coder.encode([None, ""])) == [b"", b""]
