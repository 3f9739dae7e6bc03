import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from codeloom.operators import embedding as M
from codeloom.operators import enrichment as N
from codeloom.operators import extract as X
from codeloom.plans.workload import fixed_model
from codeloom.sources import io
from codeloom.sources.vectorstore import VectorStore, embed_missing
from codeloom.streaming import jobs


def test_read_sources(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.c").write_text("int f(void) {\n}\n")
    (tmp_path / "b.c").write_bytes(b"int \xff;")
    (tmp_path / "sub" / "c.c").write_text("int g;")
    (tmp_path / "d.h").write_text("int h;")
    rows = {os.path.basename(r.file_path): r.text for r in io.read_sources(spark, str(tmp_path)).collect()}
    assert rows == {"a.c": "int f(void) {\n}\n", "b.c": "int �;"}
    empty = tmp_path / "empty"
    empty.mkdir()
    assert io.read_sources(spark, str(empty)).count() == 0
    assert X.extract_functions(io.read_sources(spark, str(empty))).count() == 0


def test_read_functions(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text('{"function_id": "a#1", "fn_no": 1}\n\n{"function_id": "a#2", "truncated": true}\n')
    rows = io.read_functions(spark, str(good)).orderBy("function_id").collect()
    assert [r.function_id for r in rows] == ["a#1", "a#2"]
    assert rows[0].labels is None and rows[0].truncated is None and rows[1].truncated
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"function_id": "a#1"}\n{"function_id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        io.read_functions(spark, str(bad)).collect()


def test_snapshot_ignores_an_unfinished_version(spark, tmp_path):
    path = str(tmp_path / "out")
    io.write_snapshot(spark.range(3), path)
    io.write_snapshot(spark.range(5), path)
    assert io.read_snapshot(spark, path).count() == 5
    os.makedirs(f"{path}/v=3")
    assert io.read_snapshot(spark, path).count() == 5
    with pytest.raises(FileNotFoundError):
        io.read_snapshot(spark, str(tmp_path / "nothing"))


def test_model_tables(spark, tmp_path):
    path = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError, match="no scaler table"):
        io.load_model_tables(spark, path)
    scaler = M.fit_scaler(spark.range(4), {"id": F.col("id")})
    model = fixed_model(4)
    io.save_model_tables(scaler, model.table(spark), path)
    loaded, again = io.load_model_tables(spark, path)
    assert again == model and loaded.first().mean == 1.5


def test_metrics_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("MRR@5", 0.123456)], "metric string, value double")
    io.write_metrics(df, str(tmp_path / "m"), {"value": 4})
    assert io.read_metrics(spark, str(tmp_path / "m"), df.schema).first().value == 0.1235


def _encode(df):
    return df.withColumn("embedding", F.array(*[F.lit(float(i)) for i in range(4)]))


def test_score_stream(spark, tmp_path):
    requests, models, out, state = (str(tmp_path / n) for n in ("in", "models", "out", "state"))
    os.makedirs(requests)

    def send(name, *rows):
        with open(f"{requests}/{name}.json", "w") as f:
            f.writelines(json.dumps({"request_id": i, "code": c}) + "\n" for i, c in rows)

    with pytest.raises(FileNotFoundError):
        jobs.score_stream(spark, requests, models, out, state)
    functions = X.extract_functions(
        spark.createDataFrame([("x.c", "int f(int a) { return g(a); }")], "file_path string, text string")
    )
    io.save_model_tables(
        M.fit_scaler(functions, M.feature_columns()), fixed_model(12).table(spark), models
    )
    send("one", (1, "int f(int a) { return g(a); } int h(void) { }"), (2, " \n"), (3, "int x;"))

    def run():
        jobs.score_stream(spark, requests, models, out, state, encode=_encode, dim=12).awaitTermination()

    run()
    send("two", (4, "void k(void) { printf(1); }"))
    run()
    run()
    scored = spark.read.parquet(f"{out}/scored").collect()
    assert sorted((r.request_id, r.name) for r in scored) == [(1, "f"), (1, "h"), (4, "k")]
    assert all(r.embedding_dim == 12 and r.embedding_preview == [0.0, 1.0, 2.0] for r in scored)
    # Every request has an outcome: blank code, and code that holds no function, are told apart.
    rejected = {r.request_id: r.reason for r in spark.read.parquet(f"{out}/rejected").collect()}
    assert rejected == {2: "code field must not be empty", 3: "no function definition found"}
    # Ids that come again are not answered again, in one file, in one batch or after a restart.
    send("three", (1, "int f2(int a) { return 0; }"), (5, "void l(void) { }"), (5, "void l(void) { }"), (2, " "))
    send("four", (5, "void l(void) { }"), (6, "void m(void) { }"), (None, "void n(void) { }"), (None, "void n(void) { }"), (None, "void o(void) { }"))
    run()
    send("five", (6, "void m(void) { }"), (4, "void k(void) { }"), (None, "void o(void) { }"), (3, "int x;"))
    run()
    scored = spark.read.parquet(f"{out}/scored").collect()
    assert sorted((r.request_id, r.name) for r in scored) == [(1, "f"), (1, "h"), (4, "k"), (5, "l"), (6, "m")]
    rejected = sorted(((r.request_id, r.reason) for r in spark.read.parquet(f"{out}/rejected").collect()), key=str)
    nameless = (None, "request_id field must not be empty")
    assert rejected == [(2, "code field must not be empty"), (3, "no function definition found"), nameless, nameless]


def test_enrich_incremental_resumes(spark, tmp_path):
    staged, out, state = (str(tmp_path / n) for n in ("staged", "out", "state"))
    df = spark.range(20).select("id", F.col("id").cast("string").alias("text")).coalesce(1)
    jobs.stage_for_enrichment(df, staged, batch=5)
    calls = {"n": 0}

    def step(batch):
        calls["n"] += 1
        if calls["n"] == 3:
            raise RuntimeError("executor lost")
        return N.enrich(batch, lambda t: t + "!", F.col("text"), "answer")

    with pytest.raises(Exception, match="executor lost"):
        jobs.enrich_incremental(spark, staged, df.schema, step, out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 10
    jobs.enrich_incremental(spark, staged, df.schema, step, out, state).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.id for r in rows) == list(range(20)) and calls["n"] == 5


def test_two_writers_of_one_version(spark, tmp_path):
    """Both start from the same version; both complete, none is lost."""
    path = str(tmp_path / "versions")
    io.write_snapshot(spark.range(1), path)
    with ThreadPoolExecutor(4) as pool:
        folders = list(pool.map(lambda n: io.write_snapshot(spark.range(n), path), range(10, 18)))
    assert sorted(int(f.rpartition("=")[2]) for f in folders) == list(range(2, 10))
    assert sorted(spark.read.parquet(f).count() for f in folders) == list(range(10, 18))
    assert io.retire_snapshots(spark, path, 3) == list(range(1, 7))
    assert io._versions(spark, path) == [7, 8, 9]
    # A writer that gave up leaves a number without a version, and readers do not see it.
    assert io.claim(spark, path, 10) and not io.claim(spark, path, 10)
    assert io.write_snapshot(spark.range(5), path, keep=1).endswith("v=11")
    assert io._versions(spark, path) == [11] and io.read_snapshot(spark, path).count() == 5


def test_vector_store_rewrites_touched_buckets_only(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "vectors"), "id", "v", buckets=16)
    schema = "id long, v array<float>, other int"
    rows = lambda ids, x: spark.createDataFrame([(i, [float(x), 0.0], 1) for i in ids], schema)
    assert store.read(rows([], 0)).collect() == [] and store.merge(rows([], 0)).n_written == 0
    assert store.merge(rows(range(1000), 1)).n_written == 1000
    done = store.merge(rows([3, 2000, 2000], 2))
    assert done.n_new == 2 and 2 < done.n_written < 250
    found = {r.id: r.v[0] for r in store.read(rows([], 0)).collect()}
    assert found == {i: 1.0 for i in range(1000)} | {3: 2.0, 2000: 2.0}
    asked = []

    def encode(missing):
        asked.append(sorted(r.id for r in missing.collect()))
        return missing.withColumn("v", F.when(F.col("id") != 1001, F.array(F.lit(9.0).cast("float"))))

    table = spark.range(990, 1005)
    assert embed_missing(table, store, encode).n_new == 4
    assert embed_missing(table, store, encode).n_new == 0
    assert asked == [[1000, 1001, 1002, 1003, 1004], [1001]]
    # Two merges at once: the second is made again on top of the first.
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: store.merge(rows([5000 + n, 6000], n)), range(4)))
    found = [r.id for r in store.read(rows([], 0)).collect()]
    assert len(found) == len(set(found)) and set(range(5000, 5004)) | {6000} <= set(found) and len(found) == 1001 + 4 + 5


def test_written_sources_are_files_of_their_own(spark, tmp_path):
    """One file per row without checksums or processes beside them; nulls and blank texts keep theirs."""
    texts = ["int a;\n", "", None, "ä\r\n\n", "int b;"]
    path = str(tmp_path / "sources")
    io.write_sources(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), path)
    assert len(os.listdir(path)) == len(texts) and all(n.endswith(".txt") for n in os.listdir(path))
    found = io.read_sources(spark, path, "*.txt").collect()
    assert sorted(r.text for r in found) == sorted((t or "") + "\n" for t in texts)
    with pytest.raises(FileExistsError):
        io.write_sources(spark.createDataFrame([("x",)], "text string"), path)
    empty = str(tmp_path / "empty")
    io.write_sources(spark.createDataFrame([], "text string"), empty)
    assert io.read_sources(spark, empty, "*.txt").count() == 0


def test_function_tables_as_json_are_compressed(spark, tmp_path):
    code = "int f(void) { return 0; }\n" * 500
    functions = X.extract_functions(spark.createDataFrame([("f.c", code)], "file_path string, text string"))
    io.write_functions(functions, str(tmp_path / "f"), "json")
    names = [n for n in os.listdir(tmp_path / "f") if n.endswith(".gz")]
    assert names and sum(os.path.getsize(tmp_path / "f" / n) for n in names) < len(code)
    assert io.read_functions(spark, str(tmp_path / "f")).count() == 500


def test_requests_move_compressed_and_without_a_join(spark, sf, tmp_path, capsys):
    from codeloom.plans.workload import _requests

    requests, _ = _requests(spark, sf)
    requests.explain()
    assert "Join" not in capsys.readouterr().out
    code = "int f(void) { return 0; }\n" * 200
    rows = [(1, code), (1, code), (2, None), (None, code), (None, code)]
    spark.createDataFrame(rows, "request_id long, code string").coalesce(1).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("request_id long, code string").json(str(tmp_path / "in"))
    first = jobs.first_requests(stream)
    first.explain()
    assert "deflate" in capsys.readouterr().out
    first.writeStream.option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start(
        str(tmp_path / "out"), format="parquet"
    ).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.request_id or 0, r.code or "") for r in found) == [(0, code), (1, code), (2, "")]


def test_code_is_unpacked_in_small_batches():
    import zlib

    import pyarrow as pa

    texts = [b"x" * 3000, None, b"", b"y" * 10, b"z" * 5000, b"ab"] * 3
    packed = pa.RecordBatch.from_pydict(
        {"request_id": list(range(len(texts))), "code": pa.array([t if t is None else zlib.compress(t) for t in texts], pa.binary())}
    )
    made = list(jobs.in_small_batches(iter([packed, packed.slice(0, 0)]), "code", zlib.decompress, 4000))
    assert [row for b in made for row in zip(*(c.to_pylist() for c in b.columns))] == list(enumerate(texts))
    # No batch goes on once it has as many bytes.
    assert all(sum(len(v or b"") for v in b.column(1).to_pylist()[:-1]) < 4000 for b in made) and len(made) > 3
