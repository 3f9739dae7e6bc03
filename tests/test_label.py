from pyspark.sql import functions as F

from codeloom.functions import effects as E
from codeloom.operators import enrichment as N
from codeloom.operators import labelling as L

NAMES = "function_id string, call_names array<string>"


def test_rules_and_ambiguity(spark):
    df = spark.createDataFrame(
        [
            ("1", ["malloc", "gpio_foo", "printf"]), ("2", ["zz"]), ("3", []), ("4", None),
            ("5", ["uart_write_bytes"]), ("6", ["xmalloc", "printfx"]), ("7", ["HAL_x", "HAL_x"]),
        ],
        NAMES,
    )
    rows = {r.function_id: r for r in L.deterministic_side_effects(df).collect()}
    assert rows["1"].side_effects == ["hardware", "io", "memory"]
    assert rows["5"].side_effects == ["hardware", "io"]
    assert rows["7"].side_effects == ["hardware"]
    assert [rows[k].is_ambiguous for k in "1234567"] == [False, True, False, False, False, True, False]
    assert rows["2"].side_effects_source == "llm_fallback"
    assert rows["3"].side_effects_source == "deterministic"
    by_table = L.side_effects_from_table(df, L.signal_table(spark)).collect()
    assert {r.function_id: r.side_effects for r in by_table} == {
        k: r.side_effects for k, r in rows.items()
    }


def test_signal_sizes(spark):
    sizes = {
        (r.label, r.kind): r["count"]
        for r in L.signal_table(spark).groupBy("label", "kind").count().collect()
    }
    assert sizes == {
        ("memory", "exact"): 10, ("io", "exact"): 18,
        ("hardware", "exact"): 35, ("hardware", "prefix"): 10,
    }


def test_replies(spark):
    cases = [
        ('```json\n{"side_effects": ["io", "alien", "io"]}\n```', ["io", "io"], "valid"),
        ("not json", ["none"], "default"),
        ("", ["none"], "default"),
        ("{}", ["none"], "default"),
        ('{"side_effects": []}', ["none"], "default"),
        ('{"side_effects": "io"}', ["none"], "default"),
        ('{"side_effects": {"io": 1}}', ["io"], "valid"),
        ("[1]", ["none"], "error"),
        ("3", ["none"], "error"),
        ('{"side_effects": null}', ["none"], "error"),
        ('{"side_effects": 4}', ["none"], "error"),
        ('{"side_effects": [["io"]]}', ["none"], "error"),
        ('{"side_effects": [1, null, "memory"]}', ["memory"], "valid"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, raw string")
    got = df.select("i", E.parse_effects_reply(F.col("raw")).alias("p")).orderBy("i").collect()
    assert [(r.p.effects, r.p.status) for r in got] == [(c[1], c[2]) for c in cases]


def test_a_reply_is_a_result_only_as_a_whole(spark):
    good = '{"side_effects": ["io"]}'
    failed = [
        good + " I hope this helps.", good + good, good + "//", good + "]", good + "] x", good + "}", good + ', "x"',
        good + ',"0"]', good + "\n" + good, '["io"], ["io"]',
    ]
    read = ["\u00a0" + good + "\u2003", "\x1c" + good, "\u3000```json\n" + good + "\n```\u0085"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(failed + read)], "i int, raw string")
    got = df.select("i", E.parse_effects_reply(F.col("raw")).alias("p")).orderBy("i").collect()
    assert [(r.p.effects, r.p.status) for r in got] == [(["none"], "default")] * len(failed) + [(["io"], "valid")] * len(read)


def test_scoring_leaves_failed_replies_without_rule_effects(spark):
    from codeloom.operators import extract
    from codeloom.plans import scoring
    from codeloom.plans.workload import M, fixed_model

    replies = {"a": '{"side_effects": ["io"]}', "b": "[1]", "c": None, "d": "none of them", "e": '{"side_effects": 4}'}

    def generate(prompt):
        name = prompt.split("f_", 1)[1][0]
        if replies[name] is None:
            raise RuntimeError("down")
        return replies[name]

    sources = spark.createDataFrame([(f"{n}.c", f"void f_{n}(void) {{ zz(); }}") for n in replies], "file_path string, text string")
    functions = extract.extract_functions(sources)
    scored = scoring.score_functions(
        functions, M.fit_scaler(functions, M.feature_columns()), fixed_model(12), generate=generate,
        encode=lambda df: df.withColumn("embedding", F.array(*[F.lit(0.5).cast("float")] * 4)), dim=12,
    )
    assert {r["name"][-1]: r["rule_side_effects"] for r in scored.collect()} == {
        "a": ["io"], "b": None, "c": None, "d": ["none"], "e": None,
    }


def label(spark, rows, generate, chat):
    df = spark.createDataFrame(
        rows,
        "function_id string, function_code string, call_names array<string>, "
        "control_flow_elements array<string>",
    )
    out = N.label_functions(df, generate, chat).collect()
    return {r.function_id: r for r in out}


def test_label_functions(spark):
    def generate(prompt):
        if "boom" in prompt:
            raise RuntimeError("down")
        return "[1]" if "listed" in prompt else '{"side_effects": ["memory"]}'

    def chat(messages):
        if "mute" in messages[0]["content"]:
            raise RuntimeError("no answer")
        return f"turn {len(messages)}"

    rows = label(
        spark,
        [
            ("clear", "code", ["printf"], ["if"]), ("asked", "code", ["zz"], None),
            ("failed", "boom", ["zz"], []), ("nocalls", "boom", [], []),
            ("odd", "listed", ["zz"], []), ("mute", "mute", ["free"], []),
        ],
        generate,
        chat,
    )
    assert rows["clear"].labels.side_effects == ["io"]
    assert rows["clear"].labels.high_level_purpose == "turn 3"
    assert rows["asked"].labels.side_effects == ["memory"]
    assert rows["asked"].side_effects_source == "llm_fallback"
    assert rows["asked"].labels.control_flow_elements == []
    assert rows["nocalls"].labels.side_effects == ["none"]
    assert rows["nocalls"].side_effects_source == "deterministic"
    for key in ("failed", "odd", "mute"):
        assert rows[key].side_effects_source == "error"
        assert rows[key].labels.high_level_purpose == "ERROR"
        assert rows[key].labels.side_effects == ["none"]


def test_both_turns_of_a_purpose_take_one_pass(spark):
    def chat(messages):
        if len(messages) == 1 and "quiet" in messages[0].get("content", ""):
            return None
        if len(messages) == 3 and "late" in messages[0].get("content", ""):
            raise RuntimeError("gone")
        return "|".join(f"{m['role']}:{m.get('content', '-')[-9:]}" for m in messages)

    df = spark.createDataFrame([("a", "code"), ("b", "quiet"), ("c", "late"), ("d", None), ("e", "")], "k string, function_code string")
    told = N.add_purpose(df, chat, on_error="none given")
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    found = {r.k: (r.high_level_purpose, r.purpose_error) for r in told.collect()}
    end = "user:sentence."
    assert found["a"] == (f"user:easoning.|assistant:easoning.|{end}", None)
    assert found["b"] == ("none given", None)
    assert found["c"] == ("none given", "RuntimeError: gone")
    assert found["d"] == (f"user:-|assistant:user:-|{end}", None)
    assert found["e"] == found["a"]


def test_scoring_extracts_once(spark, tmp_path, monkeypatch):
    from codeloom.plans import workload

    calls = []
    slices = workload.X.function_slices
    monkeypatch.setattr(workload.X, "function_slices", lambda sources: calls.append(1) or slices(sources))
    spark.createDataFrame(
        [(1, n, 2, 3, 5.0 + n, 7.5) for n in range(1, 5)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, "word and word")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    scored = workload.QUERIES["sco1_score_sources"](spark, str(tmp_path))
    assert scored.count() == 9 and len(calls) == 1


def test_pending_and_breakdown(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "function_id string")
    done = spark.createDataFrame(
        [("a", "deterministic"), ("b", "error")], "function_id string, side_effects_source string"
    )
    assert [r[0] for r in L.pending(df, done).collect()] == ["c"]
    again = L.pending(df, done, retry_errors=True).collect()
    assert sorted(r[0] for r in again) == ["b", "c"]
    joined = df.join(done, "function_id", "left")
    counts = {r.source: r.n for r in L.source_breakdown(joined).collect()}
    assert counts == {"deterministic": 1, "error": 1, "unknown": 1}


def test_a_reply_is_parsed_once(spark):
    """Reading both fields of a parsed reply does not parse it again."""
    replies = ['{"side_effects": ["io", "x"]}', '{"side_effects": {"memory": 1}}', "no", None, "[1]", '{"side_effects": [[1]]}']
    df = spark.createDataFrame([(r,) for r in replies], "r string").withColumn("p", E.parse_effects_reply(F.col("r")))
    read = df.select("r", F.col("p.effects").alias("effects"), F.col("p.status").alias("status"))
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") + plan.lower().count("parsejson") == 1
    found = {r.r: (r.effects, r.status) for r in read.collect()}
    assert found == {
        replies[0]: (["io"], "valid"), replies[1]: (["memory"], "valid"), "no": (["none"], "default"),
        None: (None, None), "[1]": (["none"], "error"), replies[5]: (["none"], "error"),
    }


def test_replies_of_events_without_a_user_keep_their_answers(spark, tmp_path):
    from codeloom.plans.workload import QUERIES

    rows = [(i, user, "{}") for user in (None, 2) for i in ((0, 1, 6, 9) if user is None else (10, 11, 16, 19))]
    spark.createDataFrame(rows, "event_id long, user_id long, props string").write.parquet(str(tmp_path / "events.parquet"))
    found = {r.event_id: (r.effects, r.status) for r in QUERIES["lab6_parse_effects_reply"](spark, str(tmp_path)).collect()}
    assert found == {
        0: ("none", "default"), 1: ("none", "default"), 6: ("none", "error"), 9: ("none", "default"),
        10: ("hardware,io", "valid"), 11: ("hardware,hardware", "valid"), 16: ("none", "error"), 19: ("none", "error"),
    }


def test_limit_rows_computes_other_columns_only_for_rows_it_keeps(spark):
    rows = [("b", 2, "3"), ("z", 1, "not a number"), ("b", 1, "2"), ("a", 1, "1"), (None, 5, "0"), ("y", 1, None)]
    df = spark.createDataFrame(rows, "file_path string, fn_no int, v string").repartition(3)
    df = df.withColumn("n", F.col("v").cast("int"))
    assert [r["n"] for r in L.limit_rows(df, 3).collect()] == [0, 1, 2]
    assert [r["n"] for r in L.limit_rows(df, 1).collect()] == [0]
    assert [r["n"] for r in L.limit_rows(df.where("file_path < 'c'"), 9, "file_path", "n").collect()] == [1, 2, 3]
    assert L.limit_rows(df.where("fn_no > 9"), 3).count() == 0
    assert L.limit_rows(df, 0).count() == 0
