"""Prefix counts against the library on every prefix."""

import random

import pytest
import sentencepiece

from codeloom.llm import tokencount as tc
from codeloom.llm import tokens

ALPHABET = [
    "a", "the", "ing", " ", "  ", "     ", "\n", "\t", "\r", "é", "é", "ß", "中", "ゼ", "\U0001f600", "\U0001f9ff",
    "\x00", "▁", "<s>", "</s>", "<unk>", "<0x41>", "1", "2024", ".", "!!", "​", "\xa0", "Ωmega", "zzzz",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokens.path(tc.VOCABULARY))


@pytest.fixture(scope="module")
def own():
    return tc.PrefixCounter(tokens.path(tc.VOCABULARY))


def test_every_prefix_equals_the_library(library, own):
    draw = random.Random(3)
    for _ in range(700):
        text = "".join(draw.choice(ALPHABET) for _ in range(draw.randrange(14)))
        want = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        prefixes = tc.Prefixes(own, text)
        assert prefixes.every() == want, text
        assert [prefixes.at(i) for i in range(len(text) + 1)] == want
        for budget in range(max(want) + 2):
            assert prefixes.longest(budget) == max(i for i, n in enumerate(want) if n <= budget), (text, budget)


def test_documents_equal_the_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = tc.token_counts(docs, limit=300).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 300)
        assert len(library.encode(texts[r.doc_id][: r.kept_chars])) <= 300
        assert (r.kept_chars == len(texts[r.doc_id])) == (n <= 300) or n > 300


def test_edge_cases(spark, library):
    texts = [None, "", " ", "x" * 50_000, "中" * 3000, " " * 5000, "a b " * 20_000, "\x00", "one", "one"]
    docs = spark.createDataFrame([(i if i < 9 else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    rows = tc.token_counts(docs, every=True).collect()
    assert [r.doc_id for r in rows] == [0, 1, 2, 3, 4, 5, 6, 7, 8, None]
    for r, t in zip(rows, texts):
        assert r.n_tokens == len(library.encode(t or "")) == r.prefix_tokens[-1]
        assert len(r.prefix_tokens) == len(t or "") + 1
    assert tc.token_counts(docs.where("false")).collect() == []
