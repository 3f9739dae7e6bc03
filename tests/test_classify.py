import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from codeloom.operators import classification as C
from codeloom.operators import logistic
from codeloom.operators import reporting as R
from tests.test_vectors import VEC, random_rows

NAMES = ["hardware", "io", "memory", "none"]


def test_split_is_exact_and_seeded(spark):
    df = spark.range(1237).withColumnRenamed("id", "k")
    first = {r.k: r.is_train for r in C.split(df, "k").collect()}
    assert sum(first.values()) == int(0.8 * 1237) and len(first) == 1237
    assert first == {r.k: r.is_train for r in C.split(df.repartition(3), "k").collect()}
    assert first != {r.k: r.is_train for r in C.split(df, "k", seed=7).collect()}
    assert all(r.is_train for r in C.split(df, "k", frac=1.0).collect())
    assert not any(r.is_train for r in C.split(df, "k", frac=0.0).collect())


def test_fit_reaches_the_optimum(spark):
    rows = random_rows(120)
    df = spark.createDataFrame(rows, VEC)
    model = C.fit_one_vs_rest(df, "v", "labels", NAMES, tol=1e-10)
    x = np.array([r[1] for r in rows])
    for i, name in enumerate(NAMES):
        y = np.array([name in r[2] for r in rows], float)
        w = np.array(model.coefficients[i])
        p = 1 / (1 + np.exp(-(x @ w + model.intercepts[i])))
        assert np.abs(x.T @ (p - y) + w).max() < 1e-2 and abs((p - y).sum()) < 1e-2
    predicted = C.predict_labels(df, "v", model).orderBy("id").collect()
    scores = x @ np.array(model.coefficients).T + model.intercepts
    for row, score in zip(predicted, scores):
        assert row.predicted_labels == ([n for n, s in zip(NAMES, score) if s > 0] or ["none"])


def test_constant_labels(spark):
    df = spark.createDataFrame([(i, [float(i)], ["a"]) for i in range(5)], VEC)
    model = C.fit_one_vs_rest(df, "v", "labels", ["a", "b"])
    assert [r.predicted_labels for r in C.predict_labels(df, "v", model).collect()] == [["a"]] * 5


def test_report(spark):
    rows = [
        (["a"], ["a"]), (["a", "b"], ["b"]), (["b"], ["a"]), (["a"], []), (["c"], ["zz"]),
    ]
    df = spark.createDataFrame(rows, "t array<string>, p array<string>")
    got = {r["class"]: r for r in C.classification_report(df, "t", "p", ["a", "b", "c"]).collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].support) == (0.5, pytest.approx(1 / 3), 3)
    assert (got["c"].precision, got["c"].recall, got["c"].f1) == (0.0, 0.0, 0.0)
    assert got["micro avg"].f1 == pytest.approx(2 * 2 / (3 + 6))
    f1 = [got[c].f1 for c in "abc"]
    assert got["macro avg"].f1 == pytest.approx(np.mean(f1))
    assert got["weighted avg"].f1 == pytest.approx(np.average(f1, weights=[3, 2, 1]))
    assert got["samples avg"].recall == pytest.approx((1 + 0.5) / 5)
    assert C.worst_class(C.classification_report(df, "t", "p", ["a", "b", "c"])).first()["class"] == "c"


def test_published_label_distribution(spark):
    rows = [["none"]] * 422 + [["memory"]] * 35 + [["hardware"]] * 19 + [["io"]] * 3
    rows += [["memory", "hardware"]] * 5
    df = spark.createDataFrame([(r,) for r in rows], "labels array<string>")
    got = C.label_distribution(df, "labels").collect()
    assert [(r.label, r.n) for r in got] == [("none", 422), ("memory", 40), ("hardware", 24), ("io", 3)]
    assert got[0].pct == pytest.approx(100 * 422 / 484)


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(1)
    data = np.round(np.concatenate([rng.exponential(5, 400), [0, 60, 60]]), 3)
    df = spark.createDataFrame([(float(x), 5.0) for x in data], "x double, c double")
    rows = R.histogram(df, {"x": F.col("x"), "c": F.col("c")}).orderBy("column", "bin").collect()
    counts, edges = np.histogram(data, bins=30)
    mine = [r for r in rows if r.column == "x"]
    assert [r.n for r in mine] == counts.tolist()
    assert [r.lo for r in mine] == pytest.approx(edges[:-1])
    constant = [r for r in rows if r.column == "c"]
    assert constant[0].lo == 4.5 and constant[-1].hi == 5.5 and sum(r.n for r in constant) == len(data)


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_describe_equals_pandas(spark, n):
    rng = np.random.default_rng(n)
    frame = pd.DataFrame({"x": np.round(rng.lognormal(3, 2, n), 2), "y": rng.integers(0, 3, n) * 1.0})
    got = {r.column: r for r in R.describe(spark.createDataFrame(frame), {c: F.col(c) for c in frame}).collect()}
    want = frame.describe().round(2)
    for c in frame:
        names = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
        for name, value in zip(names, want[c]):
            if np.isnan(value):
                assert got[c][name] is None
            else:
                assert got[c][name] == pytest.approx(value, abs=0.011)


def test_split_counts_longer_prefixes_until_the_edge_is_small(spark):
    rows = spark.range(3000).withColumnRenamed("id", "k")
    plain = {r.k for r in C.split(rows, "k").where("is_train").collect()}
    fine = {r.k for r in C.split(rows, "k", edge_rows=0).where("is_train").collect()}
    assert plain == fine and len(plain) == 2400
    assert C.split(rows, "k", frac=1.0).where("is_train").count() == 3000
    assert C.split(rows.where("false"), "k").count() == 0


def test_variants_share_their_passes_and_reach_the_optimum(spark, monkeypatch):
    rows = random_rows(200)
    df = spark.createDataFrame(rows, VEC).withColumn("short", F.slice("v", 1, 3)).repartition(5)
    passes = []
    once = logistic._evaluated
    monkeypatch.setattr(logistic, "_evaluated", lambda *a: passes.append(len(a[2])) or once(*a))
    models = C.fit_variants(df, {"all": "v", "three": "short"}, "labels", NAMES, tol=1e-9)
    for name, width in (("all", 8), ("three", 3)):
        x = np.array([r[1][:width] for r in rows])
        for i, label in enumerate(NAMES):
            y = np.array([label in r[2] for r in rows], float)
            w, b = np.array(models[name].coefficients[i]), models[name].intercepts[i]
            p = 1 / (1 + np.exp(-(x @ w + b)))
            assert np.abs(x.T @ (p - y) + w).max() < 1e-5 and abs((p - y).sum()) < 1e-5
    assert passes[0] == 8 and len(passes) < 60 and passes == sorted(passes, reverse=True)


def test_partial_sums_add_up_in_a_tree(spark):
    parts = 3 * logistic.FAN_IN + 5
    rows = spark.range(parts, numPartitions=parts).selectExpr("id")

    def one(batches):
        import pyarrow as pa

        for b in batches:
            data = [np.array([float(x), 1.0]).tobytes() for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], ["data"])

    total = logistic.summed(rows.mapInArrow(one, "data binary"), parts)
    assert total.tolist() == [parts * (parts - 1) / 2, parts]


def test_minimise_on_a_badly_scaled_bowl():
    scale = np.array([1.0, 1e3, 1e-2, 40.0])
    steps = logistic.minimise(np.array([3.0, -2.0, 50.0, 1.0]), 500, 1e-10)
    x = next(steps)
    try:
        for _ in range(2000):
            x = steps.send((0.5 * (scale * x * x).sum() + (x**4).sum(), scale * x + 4 * x**3))
    except StopIteration as end:
        assert np.abs(end.value).max() < 1e-6
    else:
        raise AssertionError("no end")


def test_fit_without_rows_or_with_bad_vectors(spark):
    df = spark.createDataFrame(random_rows(30), VEC)
    model = C.fit_one_vs_rest(df.where("false"), "v", "labels", NAMES)
    assert model.intercepts == [-C.CONSTANT_SCORE] * 4
    bad = df.unionByName(spark.createDataFrame([(99, [1.0], ["io"])], VEC))
    with pytest.raises(Exception, match="expected 8 entries"):
        C.fit_one_vs_rest(bad, "v", "labels", NAMES)


@pytest.mark.parametrize("ordered", [1, 40])
def test_quantiles_of_all_distinct_values_order_few_of_them(spark, ordered, monkeypatch):
    rng = np.random.default_rng(6)
    frame = pd.DataFrame({"x": rng.permutation(5000) / 7, "y": np.where(rng.random(5000) < 0.4, 3.5, rng.lognormal(2, 3, 5000))})
    frame["z"] = rng.integers(0, 2, 5000) * 1.0
    found = []
    once = R.wanted_stretches
    monkeypatch.setattr(R, "wanted_stretches", lambda *a: found.extend(once(*a)) or list(found))
    values = R.value_counts(spark.createDataFrame(frame), {c: F.col(c) for c in frame}).persist()
    got = {(r.column, r.prob): r.value for r in R.exact_quantiles(values, (0.0, 0.1, 0.5, 0.999, 1.0), ordered).collect()}
    for c in frame:
        for p in (0.0, 0.1, 0.5, 0.999, 1.0):
            assert got[c, p] == pytest.approx(np.quantile(frame[c], p), rel=1e-12)
    assert len(found) <= 30 and all(s.distinct <= ordered for s in found)
    assert R.exact_quantiles(values.where("false")).collect() == []
