"""Vector codes against a direct computation over all entries."""

import hashlib
import math
import random

import numpy as np
import pytest

from codeloom.llm import vectorcodes


def plain(rows, entries=256, rounds=4):
    """``{row number: (code, error)}`` and the digest, in Python integers."""
    kept = {
        n: [math.floor(1024 * v) for v in x]
        for n, (_, x, _) in enumerate(rows)
        if x is not None and all(v is not None and math.isfinite(v) for v in x)
    }
    if not kept:
        return {}, None
    size = len(next(iter(kept.values())))
    cut = [size * i // 4 for i in range(5)]
    parts = {n: [tuple(x[a:z]) for a, z in zip(cut, cut[1:])] for n, x in kept.items()}
    start = sorted(kept, key=lambda n: (rows[n][0] is None, rows[n][0] or 0, kept[n]))[:entries]
    books = [[parts[n][p] for n in start] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            members = {}
            for x in parts.values():
                members.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            books[p] = [
                tuple(sum(c) // len(members[e]) for c in zip(*members[e])) if e in members else old
                for e, old in enumerate(books[p])
            ]
    out = {}
    for n, x in parts.items():
        found = [nearest(x[p], books[p]) for p in range(4)]
        out[n] = "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)
    numbers = ",".join(str(v) for book in books for c in book for v in c)
    return out, hashlib.sha256(numbers.encode()).hexdigest()


def frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, code string, _label string"
    return spark.createDataFrame([(*r, "c", "l") for r in rows], schema)


def same(spark, rows, **sizes):
    coded, books = vectorcodes.compressed(frame(spark, rows), **sizes)
    want, digest = plain(rows, **sizes)
    label = {}
    for n, (_, error) in want.items():
        label[rows[n][2]] = label.get(rows[n][2], 0) + error
    mine = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()), key=str)
    assert mine == sorted(((rows[n][0], c, e, label[rows[n][2]]) for n, (c, e) in want.items()), key=str)
    assert (books.sha256() if books else None) == digest
    return books


@pytest.mark.parametrize("width,coarse", [(8, 4), (64, 1000), (4, 2), (10, 50)])
def test_equals_all_entries(spark, width, coarse):
    draw = random.Random(width)
    rows = [
        (draw.randrange(10**6), [draw.randint(-coarse, coarse) / 1024 + 1e-4 for _ in range(width)], draw.choice([0, 1, None]))
        for _ in range(400)
    ]
    same(spark, rows, entries=20, rounds=3)


def test_edge_cases(spark):
    draw = random.Random(1)
    vector = lambda: [draw.uniform(-2, 2) for _ in range(8)]
    twice = vector()
    rows = [
        (1, None, 1), (2, [None] + vector()[1:], 1), (3, [float("nan")] + vector()[1:], 1), (4, [float("inf")] * 8, 1),
        (0, [-float("inf")] * 8, 1), (9, twice, None), (9, twice, 2), (8, twice, 2), (None, vector(), 3), (7, [0.0] * 8, 1),
        *((n, vector(), None) for n in range(20, 40)),
    ]
    rows = [(i, x if x is None else [None if v is None else float(np.float32(v)) for v in x], lab) for i, x, lab in rows]
    same(spark, rows)
    same(spark, rows, entries=5, rounds=2)
    same(spark, rows[:5])
    same(spark, [])
    # Another dimension and a component that no 64-bit distance could hold: kept without a code.
    odd = [*rows, (50, [1.0], 1), (51, [3e38] + vector()[1:], 1), (52, [], 1)]
    coded, books = vectorcodes.compressed(frame(spark, odd))
    assert {r.vec_id: r.code for r in coded.collect() if r.vec_id in (50, 51, 52)} == {50: None, 51: None, 52: None}
    assert books.sha256() == plain(rows)[1]


def test_large_components_and_decoding(spark):
    draw = random.Random(2)
    most = vectorcodes.limit(8) // 1024
    rows = [(n, [float(np.float32(draw.choice([-most, most, n, draw.uniform(-most, most)]))) for _ in range(8)], 0) for n in range(60)]
    books = same(spark, rows, entries=7)
    assert books.decode("00010203") == [v for p, e in enumerate((0, 1, 2, 3)) for v in books.parts[p][e].tolist()]


def test_search_stops_early_where_sums_tell():
    draw = np.random.default_rng(4)
    centres = np.arange(256)[:, None] * 40 + draw.integers(-3, 4, (256, 16))
    book = vectorcodes.Codebook(draw.permutation(centres))
    x = centres[draw.integers(0, 256, 5000)] + draw.integers(-5, 6, (5000, 16))
    index, distance, met = book.nearest(x)
    every = ((x[:, None, :] - book.entries[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert met < 5000 * 256 * 0.6
