import numpy as np
import pytest
from pyspark.sql import functions as F

from codeloom.functions import vectors as V
from codeloom.operators import clustering as K
from codeloom.operators import embedding as M
from codeloom.operators import layout
from codeloom.operators import retrieval as Q

VEC = "id int, v array<double>, labels array<string>"


def random_rows(n=150, d=8, seed=3):
    rng = np.random.default_rng(seed)
    names = ["hardware", "io", "memory", "none"]
    rows = []
    for i in range(n):
        vec = rng.integers(-2, 3, d).astype(float)  # coarse values give many ties
        labels = [names[j] for j in np.flatnonzero(rng.random(4) < 0.3)] or ["none"]
        rows.append((i, vec.tolist(), labels))
    return rows


def brute_force(rows, k):
    m = np.array([r[1] for r in rows])
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    unit = np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
    sims = np.round(unit @ unit.T, 9)
    out = {}
    for i in range(len(rows)):
        order = sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-sims[i, j], j))
        out[i] = order[:k]
    return out


@pytest.mark.parametrize("block_rows,broadcast_bytes", [(4096, 64 << 20), (17, 64 << 20), (17, 0)])
def test_top_k_equals_brute_force(spark, block_rows, broadcast_bytes):
    rows = random_rows()
    df = spark.createDataFrame(rows, VEC)
    hits = Q.top_k_neighbours(
        df, df, 5, "id", "v", "labels", block_rows=block_rows, broadcast_bytes=broadcast_bytes
    )
    got = {}
    for r in hits.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.neighbour_id)
        assert r.query_labels == rows[r.query_id][2]
        assert r.neighbour_labels == rows[r.neighbour_id][2]
    assert got == brute_force(rows, 5)


def test_string_keys(spark):
    rows = random_rows(60)
    df = spark.createDataFrame([(f"{r[0]:03d}", r[1], r[2]) for r in rows], VEC.replace("id int", "id string"))
    hits = Q.top_k_neighbours(df, df, 3, "id", "v", block_rows=13).orderBy("query_id", "rank").collect()
    want = brute_force(rows, 3)
    assert [int(h.neighbour_id) for h in hits] == [j for i in range(60) for j in want[i]]


def test_few_rows_never_return_self(spark):
    df = spark.createDataFrame(random_rows(3), VEC)
    hits = Q.top_k_neighbours(df, df, 5, "id", "v").collect()
    assert len(hits) == 6 and all(h.query_id != h.neighbour_id for h in hits)


def test_metrics_equal_brute_force(spark):
    rows = random_rows()
    df = spark.createDataFrame(rows, VEC).cache()
    hits = Q.top_k_neighbours(df, df, 5, "id", "v", "labels")
    sets = [set(r[2]) for r in rows]
    mrr, r3, n_rel = [], [], []
    for i, order in brute_force(rows, 5).items():
        rel = [bool(sets[i] & sets[j]) for j in order]
        n = sum(bool(sets[i] & s) for j, s in enumerate(sets) if j != i)
        n_rel.append(n)
        mrr.append(next((1 / (p + 1) for p, x in enumerate(rel) if x), 0.0))
        r3.append(sum(rel[:3]) / min(n, 3) if n else 0.0)
    report = {r.metric: r.value for r in Q.retrieval_report(df, hits, "id", "labels").collect()}
    assert report["MRR@5"] == pytest.approx(np.mean(mrr), abs=1e-4)
    assert report["Recall@3"] == pytest.approx(np.mean(r3), abs=1e-4)
    counts = Q.relevant_count(df, "id", "labels").orderBy("query_id").collect()
    assert [c.n_relevant for c in counts] == n_rel
    chance = Q.chance_level(df, "labels").first().chance
    assert chance == pytest.approx(np.mean(n_rel) / (len(rows) - 1))


def test_top_k_plan_has_no_pair_explosion(spark):
    df = spark.createDataFrame(random_rows(), VEC)
    plan = Q.top_k_neighbours(df, df, 5, "id", "v")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "MapInArrow" in plan
    assert "WindowGroupLimit" in plan


def test_cosine_of_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert df.select(V.cosine(F.col("a"), F.col("b"))).first()[0] == 0.0


def test_scaler_and_fuse(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    columns = {"a": F.col("a"), "b": F.col("b")}
    params = {r.feature: r for r in M.fit_scaler(df, columns).collect()}
    assert params["a"].std == pytest.approx(1.2472, abs=1e-4) and params["b"].std == 1.0
    scaled = M.apply_scaler(df, columns, M.fit_scaler(df, columns))
    values = np.array([r.scaled_features for r in scaled.collect()])
    assert values.mean(axis=0) == pytest.approx([0, 0]) and values[:, 0].std() == pytest.approx(1)
    fused = M.fuse(scaled.withColumn("embedding", F.array(F.lit(3.0))), expect_dim=3)
    assert fused.first().fused_embedding[0] == 3.0
    with pytest.raises(Exception, match="expected 4 entries, got 3"):
        M.fuse(scaled.withColumn("embedding", F.array(F.lit(3.0))), expect_dim=4).collect()


def test_hash_embedding_and_encoder(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None)], "i int, t array<string>")
    rows = {r.i: np.array(r.embedding) for r in M.hash_embed(df, "t", 32).collect()}
    assert len(rows[1]) == 32 and np.linalg.norm(rows[1]) == pytest.approx(1, abs=1e-6)
    assert not rows[2].any() and not rows[3].any()
    text = spark.createDataFrame([("abc",)], "s string")
    with pytest.raises(Exception, match="expected 3"):
        M.embed(text, "s", lambda: lambda ts: [[1.0, 2.0]] * len(ts), 3).collect()


def test_require_columns(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    with pytest.raises(ValueError, match="1 rows without 'b'; run the step 'embed' first"):
        M.require_columns(df, ["a", "b"], "embed")
    assert M.require_columns(df, ["a"], "embed") is df


def test_truncation_counts_special_tokens(spark):
    df = spark.createDataFrame([(["x"] * 510,), (["x"] * 511,)], "t array<string>")
    rows = M.truncation_flag(df, "t").collect()
    assert [r.truncated for r in rows] == [False, True]
    assert [len(r.head_tokens) for r in rows] == [510, 510]


def test_published_cluster_table(spark):
    cells = [
        (0, "none", 101), (1, "none", 135), (1, "memory", 33), (1, "hardware", 1), (1, "io", 2),
        (2, "none", 186), (2, "hardware", 23), (2, "memory", 3),
    ]
    rows = [(c, [label]) for c, label, n in cells for _ in range(n)]
    df = spark.createDataFrame(rows, "cluster int, labels array<string>")
    profile = K.cluster_profile(df, "cluster", "labels", 4)
    got = {r.cluster: r for r in profile.collect()}
    assert [(got[c].size, got[c].purity) for c in range(3)] == [(101, 1.0), (171, 0.789), (212, 0.877)]
    assert got[1].distribution == {"none": 135, "memory": 33, "hardware": 1, "io": 2}
    assert (got[3].size, got[3].dominant_label, got[3].purity) == (0, "?", 0.0)
    overall = K.overall_purity(profile).first()
    assert overall.purity == pytest.approx(422 / 484) == overall.majority_share
    assert K.misfits(df, profile, "cluster", "labels").count() == 62


def test_kmeans_keeps_the_best_start(spark):
    df = spark.createDataFrame(random_rows(), VEC)
    best = K.fit_kmeans(df, "v", 3, n_init=3).summary.trainingCost
    singles = [K.fit_kmeans(df, "v", 3, n_init=1, seed=42 + i).summary.trainingCost for i in range(3)]
    assert best <= min(singles) + 1e-6


def test_projection_has_ordered_variance(spark):
    df = spark.createDataFrame(random_rows(), VEC)
    points = K.project_2d(df, {"v": "v"}, "id", "labels")
    one = points.dropDuplicates(["id"]).agg(F.var_pop("x").alias("x"), F.var_pop("y").alias("y")).first()
    assert one.x >= one.y > 0
    assert points.count() == df.select(F.explode("labels")).count()


def test_relevant_counts_of_many_labels(spark):
    """40 labels a row; the sets that meet are counted, not their subsets."""
    many = [f"l{i}" for i in range(40)]
    rows = [(1, many), (2, many[:20]), (3, many[20:]), (4, ["other"]), (5, []), (6, many)]
    frame = spark.createDataFrame(rows, "id long, labels array<string>")
    counts = {r.query_id: r.n_relevant for r in Q.relevant_count(frame, "id", "labels").collect()}
    assert counts == {1: 3, 2: 2, 3: 2, 4: 0, 5: 0, 6: 3}


def test_blocks_meet_by_pairs_and_bad_vectors_are_named(spark, sf):
    frame = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")

    def top(rows, **how):
        hits = Q.top_k_neighbours(rows, rows, 3, "vec_id", "embedding", **how)
        return hits, sorted((r.query_id, r["rank"], r.neighbour_id) for r in hits.collect())

    plain = top(frame)[1]
    grid, pairs = top(frame, block_rows=100, broadcast_bytes=0)
    assert pairs == plain
    plan = grid._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join Inner" in line and "c#" in line and "g#" in line for line in plan.split("\n"))
    for bad in ([0.5], None):
        broken = frame.unionByName(spark.createDataFrame([(9999, bad)], "vec_id long, embedding array<float>"))
        with pytest.raises(Exception, match="expected 64 entries"):
            top(broken)


def test_null_texts_do_not_reach_the_encoder(spark):
    rows = spark.createDataFrame([(1, "ab"), (2, None), (3, "c")], "id int, text string")
    out = M.embed(rows, "text", lambda: lambda texts: [[len(t), 1] for t in texts], 2).orderBy("id").collect()
    assert [r.embedding for r in out] == [[2.0, 1.0], None, [1.0, 1.0]]


def test_shared_starts_are_no_worse_and_take_fewer_passes(spark):
    df = spark.createDataFrame(random_rows(400), VEC).repartition(4)
    apart = K.fit_kmeans(df, "v", 3, n_init=5)
    shared = K.fit_kmeans_shared(df, "v", 3, n_init=5)
    assert shared.inertia <= apart.summary.trainingCost * (1 + 1e-3)
    x = np.array([r.v for r in df.collect()])
    away = ((x[:, None] - np.array(shared.centres)[None]) ** 2).sum(axis=2)
    assert shared.inertia == pytest.approx(away.min(axis=1).sum())
    for c, centre in enumerate(shared.centres):
        assert np.allclose(centre, x[away.argmin(axis=1) == c].mean(axis=0), atol=1e-5)
    one = [K.fit_kmeans_shared(df, "v", 3, n_init=1, seed=42 + i) for i in range(5)]
    assert shared.inertia == pytest.approx(min(s.inertia for s in one))
    assert shared.passes == max(s.passes for s in one)
    same = K.fit_kmeans_shared(spark.createDataFrame([(1, [2.0, 3.0], ["a"])] * 4, VEC), "v", 3)
    assert same.inertia == 0 and same.centres == [[2.0, 3.0]] * 3
    with pytest.raises(ValueError):
        K.fit_kmeans_shared(df.where("false"), "v", 3)


def test_neighbour_layout_equals_dense_eigenvectors(spark):
    draw = np.random.default_rng(2)
    middle = np.array([[5, 0, 0], [0, 5, 0], [0, 0, 5]])
    rows = [(i, (middle[i % 3] + draw.normal(size=3)).tolist(), ["a"]) for i in range(90)]
    found = layout.neighbour_layout(spark.createDataFrame(rows, VEC), "v", "id", k=6, products=35)
    matrix = np.zeros((90, 90))
    for e in found.edges.collect():
        matrix[e.src, e.dst] = e.weight
    assert np.allclose(matrix, matrix.T)
    values = np.linalg.eigvalsh(matrix)[::-1]
    assert found.values == pytest.approx(values[1:3].tolist(), abs=1e-6)
    degree = np.array([(matrix[i] > 0).sum() for i in range(90)])
    points = {p.id: (p.x, p.y) for p in found.points.collect()}
    for axis in (0, 1):
        v = np.array([points[i][axis] for i in range(90)]) * np.sqrt(degree)
        assert np.linalg.norm(matrix @ v - found.values[axis] * v) < 1e-4 and np.linalg.norm(v) == pytest.approx(1)
    assert all(r.residual < 1e-4 for r in layout.residuals(found).collect())
    # Rows of one group stand together.
    p = np.array([points[i] for i in range(90)])
    centre = np.array([p[g::3].mean(axis=0) for g in range(3)])
    near = ((p[:, None] - centre[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (near == np.arange(90) % 3).mean() > 0.9
    none = layout.neighbour_layout(spark.createDataFrame([], VEC), "v", "id")
    assert none.points.collect() == []
