"""Packing: every id in one place, windows full, and the plan against brute force."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from codeloom.llm import packing, tokens


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))


def check(rows, texts, library, window):
    """All pieces of all documents are there once, in gapless windows."""
    ids = {d: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in texts.items()}
    parts, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
    assert set(parts) == set(texts)
    for d, own in parts.items():
        own = sorted((r.start, r.length) for r in own)
        assert [a for a, _ in own] == [0, *itertools.accumulate(n for _, n in own[:-1])]
        assert sum(n for _, n in own) == len(ids[d])
    for own in windows.values():
        own.sort()
        assert [a for a, _ in own] == [0, *itertools.accumulate(n for _, n in own[:-1])]
        assert sum(n for _, n in own) <= window
    return 1 - sum(map(len, ids.values())) / (len(windows) * window)


def test_documents_are_packed_tightly(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    waste = check(packing.pack(docs).collect(), texts, library, 2048)
    assert waste < 0.02


def test_edge_cases(spark, library):
    texts = {1: None, 2: "", 3: "word " * 30_000, 4: "a <|endoftext|>  b", 5: "x" * 5000, 6: "one two"}
    texts |= {100 + i: "same text " * 60 for i in range(200)}
    docs = spark.createDataFrame([(d, t, 7, 8) for d, t in texts.items()], "doc_id long, text string, part int, bin int")
    check(packing.pack(docs, window=64, step=4, small=2).collect(), texts, library, 64)
    check(packing.pack(docs).collect(), texts, library, 2048)
    assert packing.pack(docs.where("false")).collect() == []
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (5, None), (5, None)], "doc_id long, text string")
    assert len(packing.pack(odd).collect()) == 4


def test_combinations_equal_brute_force():
    for size, depth, least in ((12, 3, 2), (9, 2, 1), (7, 1, 3), (3, 3, 4)):
        want = {
            c for n in range(1, depth + 1) for c in itertools.combinations_with_replacement(range(least, size + 1), n) if sum(c) == size
        }
        got = packing.combinations(size, depth, least)
        assert len(got) == len(set(got)) and set(got) == want


def test_least_squares_meets_its_conditions():
    draw = np.random.default_rng(1)
    for _ in range(20):
        a, b = draw.integers(0, 3, (12, 30)).astype(float), draw.integers(0, 50, 12).astype(float)
        x = packing.least_squares(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-4 and abs(slope[x > 0]).max(initial=0) < 1e-4


def test_plan_takes_each_piece_once():
    draw = random.Random(4)
    histogram = {b: draw.randrange(200) for b in range(1, 65)} | {40: 30_000, 24: 20_000}
    slots = packing.plan(histogram, 64)
    windows, taken = defaultdict(int), defaultdict(list)
    for b, low, high, first, _ in slots:
        taken[b].append((low, high))
        for w in range(first, first + high - low):
            windows[w] += b
    assert set(windows.values()) == {64}
    for b, spans in taken.items():
        spans.sort()
        assert [a for a, _ in spans] == [0, *(z for _, z in spans[:-1])] and spans[-1][1] <= histogram[b]
    assert len(windows) > 0.9 * sum(b * n for b, n in histogram.items() if b > 8) / 64 - 10_000
    assert packing.plan({}, 64) == []
