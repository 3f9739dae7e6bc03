"""Tiling against a direct greedy search, and leaks against all pairs."""

import random
import time

import numpy as np

from codeloom.llm import decontaminate as dec


def plain_tiles(item, text, least=5):
    """Mark the longest common run of unmarked ids, earliest first, until none is long enough."""
    p, t = list(item), list(text)
    used_p, used_t, found = set(), set(), []
    while True:
        best = None
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and p[i + n] == t[j + n] and i + n not in used_p and j + n not in used_t:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (i, j, n)
        if best is None:
            return found
        found.append(best)
        used_p.update(range(best[0], best[0] + best[2]))
        used_t.update(range(best[1], best[1] + best[2]))


def test_tiles_equal_a_direct_search():
    draw = random.Random(3)
    for _ in range(150):
        words = draw.choice([3, 8, 40])
        item = np.array([draw.randrange(1, words + 1) for _ in range(draw.randrange(1, 60))], np.int64)
        parts = [[draw.randrange(1, 99) for _ in range(draw.randrange(6))] for _ in range(4)]
        for k in range(0, 4, 2):
            a = draw.randrange(len(item))
            parts[k] += item[a : a + draw.randrange(25)].tolist()
        text = np.array([x for p in parts for x in p], np.int64)
        got = dec.tiles(item, text)
        assert sum(n for *_, n in got) == sum(n for *_, n in plain_tiles(item, text))
        for i, j, n in got:
            assert n >= 5 and (item[i : i + n] == text[j : j + n]).all()


def test_dense_and_listed_runs_agree(monkeypatch):
    draw = random.Random(9)
    for _ in range(300):
        words = draw.choice([1, 2, 3, 10])
        item = np.array([draw.randrange(words) for _ in range(draw.randrange(5, 40))], np.int64)
        text = np.array([draw.randrange(words) for _ in range(draw.randrange(5, 90))], np.int64)
        found = []
        for dense in (0, 10**9):
            monkeypatch.setattr(dec, "DENSE", dense)
            found.append(dec.tiles(item, text))
        assert found[0] == found[1]


def test_items_of_repeated_words_stay_cheap():
    for period in (1, 2, 3):
        item = np.arange(1, 1001, dtype=np.int64) % period + 1
        text = np.arange(1, 20_001, dtype=np.int64) % period + 1
        start = time.process_time()
        assert dec.tiles(item, text) == [(0, 0, 1000)]
        assert dec.tiles(np.tile(item, 1)[:800], text[:700])[0][2] >= 700 - period
        assert time.process_time() - start < 20


def plain_leaks(docs, items):
    rows = []
    for doc_id, text in docs:
        t = dec.normal_words(text and text.encode())
        grams = {tuple(t[k : k + 5]) for k in range(len(t) - 4)}
        for item_id, passage in items:
            p = dec.normal_words(passage and passage.encode())
            if len(p) < 5 or not any(tuple(p[k : k + 5]) in grams for k in range(len(p) - 4)):
                continue
            runs = plain_tiles(p, t)
            matched = sum(n for *_, n in runs)
            if matched >= 0.8 * len(p):
                rows.append((doc_id, item_id, len(p), matched, len(runs)))
    return sorted(rows, key=str)


def test_leaks_equal_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    want = plain_leaks(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    )
    assert want
    got = dec.leaks(docs, items)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == want
    # Many small indexes give the same rows.
    sliced = dec.leaks(docs, items, index_bytes=2000)
    assert sorted((tuple(r)[:5] for r in sliced.collect()), key=str) == want
    left = dec.drop_leaking(docs, items, index_bytes=4000)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - {r[0] for r in want}


def test_edge_cases(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame(
        [
            (1, "x " + item + " y", "a"), (2, "six seven eight, nine TEN! one two three four five", "b"),
            (3, "one two three four five six seven", "c"), (4, None, "d"), (5, "", "e"), (None, item, "f"),
            (1, "x " + item + " y", "a"), (6, (item + " ") * 2000, "g"), (7, "one two three four", "h"),
        ],
        "doc_id long, text string, item_id string",
    )
    items = spark.createDataFrame(
        [(10, item, 1), (11, "one two three", 2), (12, None, 3), (13, "", 4), (14, item, 5)], "item_id long, text string, doc_id int"
    )
    rows = [(r.doc_id, r.item_id, r.coverage) for r in dec.leaks(docs, items).collect()]
    want = [(d, i, 1.0) for d in (1, 1, 2, 6, None) for i in (10, 14)]
    assert sorted(rows, key=str) == sorted(want, key=str)
    assert sorted(r.item_id for r in dec.drop_leaking(docs, items).collect()) == ["c", "d", "e", "h"]
    assert dec.leaks(docs.where("false"), items).collect() == []
    assert dec.leaks(docs, items.where("false")).collect() == []
    assert dec.drop_leaking(docs, items.where("false")).count() == 9
