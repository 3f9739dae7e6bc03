"""Pruned search against all pairs."""

import numpy as np
import pytest

from codeloom.operators import neighbours as P
from codeloom.operators import retrieval as Q

VEC = "id long, v array<float>, labels array<string>"


def clustered(n, d=8, centres=30, seed=1, spread=0.05):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centres, d))
    rows = middle[draw.integers(0, centres, n)] + spread * draw.normal(size=(n, d))
    return [(i, [float(x) for x in np.float32(v)], [f"l{i % 3}"]) for i, v in enumerate(rows)]


def both(spark, queries, corpus, k, block_rows, worth=10.0, **how):
    q = spark.createDataFrame(queries, VEC)
    c = q if queries is corpus else spark.createDataFrame(corpus, VEC)
    found = P.pruned_neighbours(q, c, k, "id", "v", "labels", block_rows=block_rows, worth=worth, **how)
    plain = Q.top_k_neighbours(q, c, k, "id", "v", "labels")
    columns = plain.columns
    key = lambda df: sorted(tuple(map(str, r)) for r in df.select(*columns).collect())
    assert key(found.hits) == key(plain)
    return found


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_clustered_rows_meet_few_others(spark, broadcast_bytes):
    rows = clustered(2500)
    found = both(spark, rows, rows, 5, 50, broadcast_bytes=broadcast_bytes)
    assert found.compared < 0.5 * found.possible
    assert found.compared < 0.15 * found.possible


def test_other_queries_zeros_and_copies(spark):
    corpus = clustered(600)
    corpus += [(1000 + i, [0.0] * 8, ["z"]) for i in range(40)] + [(2000 + i, corpus[7][1], ["c"]) for i in range(300)]
    corpus += [(3000, [-x for x in corpus[0][1]], None), (3001, [1e-30] * 8, ["t"])]
    queries = corpus[::5] + [(90_000 + i, r[1], ["q"]) for i, r in enumerate(clustered(200, seed=9))]
    for k in (1, 4):
        both(spark, queries, corpus, k, 20)
    both(spark, corpus, corpus, 3, 33)
    both(spark, queries, corpus[:3], 5, 2)


def test_copies_do_not_pair_up(spark):
    one = clustered(40)
    rows = one + [(100 + i, one[3][1], ["c"]) for i in range(1500)]
    found = both(spark, rows, rows, 4, 16)
    assert found.compared < 0.1 * found.possible


def test_random_rows_fall_back_to_all_pairs(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(draw.normal(size=48))], ["l"]) for i in range(400)]
    frame = spark.createDataFrame(rows, VEC)
    assert P.pruned_neighbours(frame, frame, 5, "id", "v", block_rows=20) is None
    both(spark, rows, rows, 5, 20)
    got = P.nearest(frame, frame, 5, "id", "v", block_rows=20)
    assert got.count() == 2000


def test_empty_sides(spark):
    rows = spark.createDataFrame(clustered(50), VEC)
    assert P.nearest(rows.where("false"), rows, 3, "id", "v", block_rows=4).collect() == []
    assert P.nearest(rows, rows.where("false"), 3, "id", "v", block_rows=4).collect() == []
    assert P.pruned_neighbours(rows.where("id < 0"), rows, 3, "id", "v", block_rows=4).hits.collect() == []


def test_bounds_hold():
    draw = np.random.default_rng(5)
    sample = draw.normal(size=(500, 6))
    pivots = P.choose_pivots(sample, 12)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    own = (unit @ pivots.T).argmax(axis=1)
    angle = np.arccos(np.clip((unit * pivots[own]).sum(axis=1), -1, 1))
    shell = (angle > np.median(angle)).astype(int)
    names = sorted(set(zip(own.tolist(), shell.tolist())))
    inside = [np.flatnonzero((own == p) & (shell == s)) for p, s in names]
    cells = P.Cells(
        pivots, np.array([p for p, _ in names]), np.array([angle[i].min() for i in inside]),
        np.array([angle[i].max() for i in inside]), np.array([len(i) for i in inside]), 10,
    )
    reach = cells.reach(unit)
    for c, members in enumerate(inside):
        assert (reach[:, c] >= (unit @ unit[members].T).max(axis=1) - 1e-9).all()
    assert all(sum(cells.rows[h]) > 7 for h in cells.homes(7))


def test_hits_of_many_blocks_are_merged_before_they_are_ranked(spark):
    rows = clustered(600, d=24)
    frame = spark.createDataFrame(rows, VEC)
    left = Q._blocks(frame, "id", "v", "labels", 1, "q", 24)
    right = Q._blocks(frame, "id", "v", "labels", 20, "c", 24).coalesce(1)
    hits = Q.block_products(left.crossJoin(right), 3, frame.schema["id"].dataType)
    assert 3 * 600 <= hits.count() < 2 * 3 * 600
    both(spark, rows, rows, 3, 20)


def test_rough_products_give_the_same_best_columns():
    import pyarrow as pa

    draw = np.random.default_rng(8)
    for d, n in ((4, 900), (40, 900), (40, 30)):
        vectors = draw.normal(size=(n, d))
        vectors[n // 2 :: 3] = vectors[1]
        vectors[5::7] = vectors[5::7].round()
        vectors[9] = 0
        units = Q.Units(pa.array(vectors.ravel()), n)
        same = np.arange(n), np.arange(n)
        sims = np.round(units.double @ units.double.T, Q.SIMILARITY_DECIMALS)
        sims[same] = -np.inf
        rows, cols = Q.best_of_block(sims, 4)
        got = Q.near_columns(units, slice(None), units, slice(None), 4, same, np.full(n, -np.inf))
        assert (got[0] == rows).all() and (got[1] == cols).all() and (got[2] == sims[rows, cols]).all()


def test_reached_cells_hold_all_near_rows():
    draw = np.random.default_rng(6)
    sample = draw.normal(size=(700, 4))
    pivots = P.choose_pivots(sample, 15)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    own = (unit @ pivots.T).argmax(axis=1)
    angle = np.arccos(np.clip((unit * pivots[own]).sum(axis=1), -1, 1))
    shell = (angle > np.median(angle)).astype(int)
    names = sorted(set(zip(own.tolist(), shell.tolist())))
    inside = [np.flatnonzero((own == p) & (shell == s)) for p, s in names]
    cells = P.Cells(
        pivots, np.array([-1] + [p for p, _ in names]), np.array([0] + [angle[i].min() for i in inside]),
        np.array([0] + [angle[i].max() for i in inside]), np.array([1] + [len(i) for i in inside]), 10,
    )
    sims = unit @ unit.T
    kth = np.sort(sims, axis=1)[:, -4]
    need = cells.reached(unit, kth)
    for c, members in enumerate(inside, 1):
        assert (need[:, c] | (sims[:, members].max(axis=1) < kth)).all()
    assert need[:, 1:].mean() < 0.5
    assert cells.reached(unit, np.full(700, -2.0)).all()
    assert not cells.reached(unit, kth)[kth > 0.1, 0].any()
    first, blocks = P.dealt(np.array([3, 4, 25, 1, 9, 2]), 10)
    assert first.tolist() == [0, 0, 1, 4, 4, 5] and blocks.tolist() == [1, 1, 3, 1, 1, 1]
