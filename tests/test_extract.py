import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from codeloom.functions import clex
from codeloom.functions.treeheight import BINARY, RIGHT, height_of
from codeloom.operators import extract as X
from codeloom.sources.tables import corpus_sources

SCHEMA = "file_path string, text string"

EDGE = r'''/* if( { */
#include <a.h>
#define LOOP(x) do { \
   x; } while (0)
struct A { int x; };
int t[] = {1,2};
int q(int);
struct foo v = (struct foo){1,2};
int busy(int n)
{
  // free(p) {
  const char *s = "if (%d) {", **tt, c = '}';
  obj->cb(1); (*fn)(2); foo(bar(1)); (int)(x); a.b->c(1); tab[i](3); ((foo_t *)p)->run(1);
  void (*cb)(int) = x; my_t (*cc)(int);
  do { n--; } while (n > 0);
  a = b * c;
  return sizeof(n);
}
static char **mk(const char *s, int n, ...) { return 0; }
void IRAM_ATTR isr(void) { switch (x) { case 1: break; default: continue; } goto end; }
void __attribute__((noinline)) at(void (*cb)(int, int), char *) __attribute__((x)) { }
int none() { return 1; }
'''


def extract(spark, text):
    rows = X.extract_functions(spark.createDataFrame([("f.c", text)], SCHEMA)).collect()
    return {r.function_name: r for r in sorted(rows, key=lambda r: r.fn_no)}


def test_edge_cases(spark):
    fns = extract(spark, EDGE)
    assert list(fns) == ["busy", "mk", "isr", "at", "none"]
    busy = fns["busy"]
    assert busy.call_names == [
        "obj->cb", "(*fn)", "foo", "bar", "a.b->c", "tab[i]", "((foo_t*)p)->run",
    ]
    assert busy.control_flow_elements == ["do_while", "return"]
    f = busy.ast_features
    assert (f.if_count, f.loop_count, f.return_count, f.call_count) == (0, 1, 1, 7)
    assert f.pointer_count == 1 + 2 + 1 + 1 and f.param_count == 1 and f.line_count == 10
    assert busy.function_code.startswith("int busy(int n)") and busy.function_code.endswith("}")
    assert fns["mk"].ast_features.param_count == 2 and fns["mk"].ast_features.pointer_count == 3
    assert fns["isr"].ast_features.param_count == 1
    assert fns["isr"].control_flow_elements == ["break", "continue", "goto", "switch"]
    assert fns["at"].ast_features.param_count == 2 and fns["at"].ast_features.pointer_count == 1
    assert fns["none"].ast_features.param_count == 0


def test_conditional_branches_stay_balanced(spark):
    text = (
        "int k(int a) {\n#if A\n if (a) {\n#else\n if (b) {\n#endif\n }\n return zz();\n}\n"
        "#ifdef __cplusplus\nextern \"C\" {\n#endif\nint w(void) { return 2; }\n"
        "#ifdef __cplusplus\n}\n#endif\nint last(void) { return 3; }\n"
    )
    fns = extract(spark, text)
    assert list(fns) == ["k", "w", "last"]
    assert fns["k"].ast_features.if_count == 2


def test_unbalanced_file_is_reported(spark):
    src = spark.createDataFrame([("bad.c", "int f(void) { if (x) {"), ("ok.c", "int g;")], SCHEMA)
    assert [r.file_path for r in X.rejected_sources(src).collect()] == ["bad.c"]
    assert X.extract_functions(src).count() == 0


def test_files_without_functions_are_counted(spark):
    src = spark.createDataFrame([("a.c", "int f(void) {}\nint g(void) {}"), ("b.c", "")], SCHEMA)
    counts = X.functions_per_file(src, X.function_slices(src)).collect()
    assert {r.file_path: r.n_functions for r in counts} == {"a.c": 2, "b.c": 0}
    stats = X.corpus_stats(X.extract_functions(src.where("file_path = 'b.c'"))).first()
    assert stats.avg_lines == 0 and stats.max_lines is None


def test_long_literals_do_not_overflow(spark):
    text = 'char *s = "' + "\\n" * 200_000 + '";\nint f(void) { /*' + "*" * 200_000 + "*/ g(); }\n"
    assert extract(spark, text)["f"].call_names == ["g"]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet='ab1 \n\t"\'/*#\\{}();->é', max_size=60), min_size=1, max_size=6))
def test_tokens_tile_the_text(spark, texts):
    src = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], SCHEMA)
    rows = X.tokenize_sources(src).orderBy("file_path", "pos").collect()
    for i, text in enumerate(texts):
        mine = [r for r in rows if r.file_path == str(i)]
        assert "".join(r.tok for r in mine) == text
        for r in mine:
            assert text[r.off : r.off + len(r.tok)] == r.tok
            assert r.line == text[: r.off].count("\n") + 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extraction_needs_no_shuffle(spark, sf):
    src = spark.createDataFrame([("f.c", EDGE)], SCHEMA)
    plan = plan_of(X.extract_functions(src))
    assert "Exchange" not in plan and "Python" not in plan and plan.count("posexplode") == 1
    tokens = plan_of(X.tokenize_sources(src))
    assert tokens.count("Exchange") == 1 and tokens.count("Sort ") == 1
    assert corpus_sources(spark, sf).columns == ["file_path", "text"]


HEADS = r'''
int proto(int), x;
/* old; style( */ int knr(a, b) int a; char *b; { return a; }
static unsigned long old2(fn, n)
    int (*fn)(int); /* one */
    int n;
{ return (*fn)(n); }
int trail(void) NOEXCEPT { return 1; }
int sec(int a) SECTION(".x") COLD { return 2; }
#ifdef A
int cond(int a)
#else
int cond(long a)
#endif
{ return 3; }
struct __attribute__((packed)) P { int z; };
struct P *mk(void) { return 0; }
int (*getfn(int a, int b))(void) { return f; }
ATTR(1) int macro(int a) { return 4; }
int deep(int (*a)(int (*)(int (*)(int (*)(int (*)(int (*)(int (*)(int)))))))) { return 5; }
enum E { A = (1), B };
int arr[2] = { 1, (2) };
'''


def test_heads_of_definitions(spark):
    fns = extract(spark, HEADS)
    assert list(fns) == [
        "knr", "old2", "trail", "sec", "cond", "mk", "(*getfn(int a, int b))", "macro", "deep",
    ]
    params = {n: f.ast_features.param_count for n, f in fns.items()}
    assert list(params.values()) == [2, 2, 1, 1, 1, 1, 1, 1, 1]
    assert fns["knr"].function_code == "int knr(a, b) int a; char *b; { return a; }"
    assert fns["old2"].function_code.startswith("static unsigned long old2(fn, n)")
    assert fns["old2"].call_names == ["(*fn)"]
    src = spark.createDataFrame([("a.c", HEADS), ("b.c", "int a; whatever { x(); }\nint f(void) { }")], SCHEMA)
    assert [(r.file_path, r.unknown_blocks) for r in X.rejected_sources(src).collect()] == [("b.c", 1)]


CALLS = r'''void all(void)
{
  m[a[b[c]]](1); (*get(x))(y); ((T)(p))->fn(3); f(1)->g(2); h(1)(2);
  if (q(1)) (*cb)(2); else ((T *)p)->run(k(4)); while (w()) tab[i].go();
  x = (int)(y) + sizeof(z); return (a)->last(deep(((((((((1))))))))));
}
'''


def test_callees_of_any_form(spark):
    assert extract(spark, CALLS)["all"].call_names == [
        "m[a[b[c]]]", "(*get(x))", "get", "((T)(p))->fn", "f(1)->g", "f", "h(1)", "h",
        "q", "(*cb)", "((T*)p)->run", "k", "w", "tab[i].go", "(a)->last", "deep",
    ]


TYPES = r"""
typedef struct tree { struct tree * left; int v; } tree_t, *tree_p;
typedef int (*hook)(int *, char);
typedef unsigned char byte, row[4];
enum e { A };
int f(list * l, int a, item **b) { a * b; list * x; tree_t * t, **u = 0; tree_p * v[2]; hook * h; byte * y; row * z; return a * b; }
int g(int tree_t) { tree_t * a; free_name * b; size_t * n; x = (cast_t *) y; cast_t * c; thing one; thing * two; for (q * r; ;) { } }
"""


def test_products_are_no_pointers(spark):
    src = spark.createDataFrame([("a.c", TYPES), ("b.c", "void h(int n) { tree_p * p; item * i; other * o; }")], SCHEMA)
    types = {r.name for r in X.known_types(src).collect()}
    assert types >= {"tree_t", "tree_p", "hook", "byte", "row", "list", "item", "cast_t", "thing", "size_t"}
    assert not types & {"a", "b", "left", "free_name", "q", "other", "int", "tree", "l"}
    functions = X.extract_functions(src)
    got = {r.function_name: r.ast_features.pointer_count for r in X.resolve_pointers(functions, X.known_types(src)).collect()}
    # f: two parameters (three stars), x, t, u (two), v, h, y, z; g: n, c, two; h: p and i
    assert got == {"f": 3 + 1 + 1 + 2 + 1 + 1 + 1 + 1, "g": 3, "h": 2}
    assert X.resolve_pointers(functions, X.known_types(src)).columns == functions.columns
    assert X.resolve_pointers(functions.where("false"), X.known_types(src)).collect() == []


@pytest.mark.parametrize("statement,height", [
    ("x;", 1), (";", 1), ("a + b * c;", 3), ("a * b + c;", 3), ("a = b = c;", 3), ("a + b + c;", 3), ("!(a);", 3), ("f();", 3),
    ("f(a, b + c);", 4), ("a->b->c;", 3), ("a.b++;", 3), ("*a[1]++;", 4), ("if (a) b; else c;", 3), ("if (a) b; else if (d) c;", 4),
    ("do { x; } while (a + b);", 3), ("for (i = 0; i < n; i++) { g(); }", 5), ("return a ? b + 1 : c ? d : e;", 3), ("return;", 1),
    ("switch (a) { case 1: x(); break; default: y; }", 6), ("x = (int) y;", 4), ("x = (T *) *y;", 5), ("int a = {1, {2}};", 4),
    ("out: x;", 2), ("a ? b = 1 : c;", 3), ("x = sizeof(int);", 4), ("((T *)p)->run(k(4));", 7), ("(a)(b);", 3),
])
def test_tree_height_of_statements(statement, height):
    assert height_of("int f(void) { " + statement + " }") == 2 + height


def _grown(draw, depth):
    """A random expression that is bracketed where its tree asks for it: text, height, level of its operator."""
    kind = draw.choice(["leaf", "binary", "call", "index", "member", "unary", "group"]) if depth else "leaf"
    if kind == "leaf":
        return draw.choice(["a", "b1", "b42", '"s;{"', "'}'"]), 0, 99

    def part(least):
        text, height, level = _grown(draw, depth - 1)
        return (text, height) if level > least else (f"({text})", height + 1)

    if kind == "binary":
        op = draw.choice([o for o in BINARY if o not in "?:"])
        level = BINARY[op]
        left, right = part(level if level in RIGHT else level - 0.5), part(level - 0.5 if level in RIGHT else level)
        return f"{left[0]} {op} {right[0]}", 1 + max(left[1], right[1]), level
    if kind == "unary":
        text, height = part(12.5)
        return draw.choice("-!~*&") + " " + text, 1 + height, 13
    if kind == "group":
        text, height, _ = _grown(draw, depth - 1)
        return f"({text})", 1 + height, 99
    text, height = part(13)
    if kind == "member":
        return text + draw.choice([".m", "->m"]), 1 + height, 99
    inner = _grown(draw, depth - 1)
    if kind == "index":
        return f"{text}[{inner[0]}]", 1 + max(height, inner[1]), 99
    other = _grown(draw, depth - 1)
    return f"{text}({inner[0]}, {other[0]})", 1 + max(height, 1 + max(inner[1], other[1])), 99


def test_tree_height_of_grown_functions():
    draw = random.Random(8)

    def statement(depth):
        text, height, _ = _grown(draw, draw.randrange(5))
        kind = draw.choice(["plain", "return", "if", "else", "while", "do", "block"]) if depth else "plain"
        if kind in ("plain", "return"):
            return ("return " if kind == "return" else "") + text + ";", 1 + height
        one, two = statement(depth - 1), statement(depth - 1)
        if kind == "block":
            return "{ " + one[0] + "\n" + two[0] + " }", 1 + max(one[1], two[1])
        if kind == "else":
            return f"if ({text}) {{ {one[0]} }} else {two[0]}", 1 + max(1 + height, 1 + one[1], 1 + two[1])
        if kind == "do":
            return f"do {{ {one[0]} }} while ({text});", 1 + max(1 + one[1], 1 + height)
        # The brace keeps an else that follows with its own if.
        return f"{kind} ({text}) {{ {one[0]} }}", 1 + max(1 + height, 1 + one[1])

    for _ in range(1500):
        text, height = statement(draw.randrange(4))
        assert height_of("int f(void) {\n#if A\n" + text + "\n#else\n{ x(((1)));\n#endif\n}") == 2 + height, text


def test_tree_height_of_broken_and_deep_texts(spark):
    draw = random.Random(1)
    signs = "a b if while for switch do else case default return ( ) [ ] { } ; , : ? = + - * & -> . ++ ! sizeof int 1 goto ...".split()
    for i in range(4000):
        text = " ".join(draw.choice(signs) for _ in range(draw.randrange(30)))
        assert height_of(("int f(void) { " if i % 2 else "") + text) >= 0
    assert height_of("int f(void) { x = " + "(" * 50_000 + "a" + ")" * 50_000 + "; }") == 50_004
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "int f(void) { }")], "i int, function_code string")
    assert [r.tree_height for r in X.with_tree_height(rows).orderBy("i").collect()] == [None, 0, 3]
    assert "Exchange" not in plan_of(X.with_tree_height(rows))


def test_blocks_that_close_are_one_chunk(spark):
    """The fold of a file takes a step per top-level block, not one per brace."""
    body = "".join(f"  if (a{i}) {{ while (b) {{ go({i}); }} }}\n" for i in range(200))
    text = f"#include <a.h>\n#define N 1\nstruct S {{ int z; }};\nint f(int a)\n{{\n{body}}}\nextern \"C\" {{ int g(void) {{ h(); }} }}\n"
    df = spark.createDataFrame([("f.c", text)], SCHEMA)
    assert df.select(clex.chunks(F.col("text"))).first()[0].__len__() < 12
    fns = {r.function_name: r for r in X.extract_functions(df).collect()}
    assert list(fns) == ["f", "g"]
    f = fns["f"].ast_features
    assert (f.if_count, f.loop_count, f.call_count, f.nesting_depth) == (200, 200, 200, 4)


def test_depth_of_deep_and_open_brackets(spark):
    cases = {"": 0, "()": 1, "{[()]()}": 3, "(" * 40 + ")" * 40: 40, "((": 2, ")((": 1, "(()" * 20: 21, "a" + "()" * 3000: 1}
    rows = spark.createDataFrame(list(cases.items()), "clean string, depth int")
    assert rows.where(clex.nesting_depth(F.col("clean")) != F.col("depth")).collect() == []


def test_tokens_of_more_text_are_ordered_by_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(X, "TOKENIZED_BYTES", 1000, raising=False)
    src = spark.createDataFrame([(str(i), "a b;\n" * 100) for i in range(100)], SCHEMA)
    tokens = X.tokenize_sources(src)
    assert re.search(r"hashpartitioning\(file_path#\d+, 50\), REPARTITION_BY_NUM", plan_of(tokens))
    assert tokens.count() == 100 * 500
    assert X.tokenize_sources(src.limit(0)).count() == 0


def test_plain_files_are_cut_by_one_pattern_and_others_by_the_fold(spark):
    plain = [
        EDGE.replace("__attribute__((noinline))", "NOINLINE").replace("__attribute__((x))", ""),
        "int k(int a) {\n#if A\n if (a) {\n#else\n if (b) {\n#endif\n }\n return zz();\n}\nint (*p(int a))(void) X\n#ifdef Y\n#endif\n{ }\n",
        "int q(int);\nlong old(a, b)\n int a;\n char *b;\n{ m[a](1); }\nint x;\n",
        "",
    ]
    other = ["int f(void) { if (x) {", EDGE, 'extern "C" {\nint w(void) { return 2; }\n}\n', "int f(void) {\n#else\n}\n", "int f(void) { 'x; }\n}"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(plain + other)], "i int, text string")
    text, parts, chunk, scan = (F.col(c) for c in ("text", "_p", "_c", "_s"))
    steps = rows.withColumns({"_p": clex.plain_parts(text), "_c": clex.chunks(text)}).withColumn("_s", clex.scan_chunks(chunk))
    found = steps.select("i", clex.plain_definitions(parts).alias("one"), clex.definition_texts(chunk, scan).alias("two")).orderBy("i").collect()
    assert [r.one is None for r in found] == [False] * len(plain) + [True] * len(other)
    assert all(r.one == r.two for r in found[: len(plain)])
    assert [len(r.one) for r in found[: len(plain)]] == [5, 2, 1, 0]


def test_long_files_without_plain_shape_are_read_in_one_go(spark):
    texts = ["word " * 200_000, "M(a) int x; " * 20_000, "M(a) int x; " * 100 + "{ }", "}" * 50_000 + " int f(void) { }", "word " * 50_000 + "f(void) { }"]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], SCHEMA)
    assert X.function_slices(rows).groupBy("file_path").count().orderBy("file_path").collect() == [("2", 1), ("3", 1), ("4", 1)]


def test_plain_callees_are_those_of_the_full_pattern(spark):
    rng = random.Random(7)
    parts = ["f", "if", "x1", "2a", "do", "_Bool", "sizeof", "double", "é", "(", ")", "[", "]", ".", "->", "-", " ", " ", ";", "{", "}", ",", "*", ">", "f(", "g (", "a.b(", "p->q("]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(20_000)]
    df = spark.createDataFrame([(re.sub(" +", " ", t),) for t in texts], "t string").where(~F.col("t").rlike(clex._AFTER_BRACKET))
    found = [F.regexp_extract_all("t", F.lit(p), F.lit(1)) for p in (clex._PLAIN_CALL, clex._CALL)]
    got = df.select("t", found[0].alias("plain"), found[1].alias("full")).collect()
    assert len(got) > 10_000 and sum(len(r.full) > 1 for r in got) > 500
    assert [r for r in got if r.plain != r.full] == []


def test_any_run_of_blanks_is_one_space(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("a;\u00a0 \t\n\x0b\f\r", k=rng.randint(0, 12))) for _ in range(5_000)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", clex.squeezed(F.col("t")).alias("s")).collect()
    assert [r for r in got if r.s != re.sub("[ \t\n\x0b\f\r]+", " ", r.t)] == []


def test_statements_before_a_head_are_passed_over_only_where_a_brace_follows_at_once(spark):
    def parts(text):
        df = spark.createDataFrame([(text,)], "t string")
        return df.select(clex.plain_definitions(clex.plain_parts(F.col("t"))).alias("p")).first().p

    old = "int f(a)\n  int a; /* { */\n  char *b;\n{ return a; }"
    assert parts(f"int x = g(1); {old}\nint h(void) {{ }}") == [old, "int h(void) { }"]
    assert parts("int v = a ? (b) : c, w[2] = {1, 2}; void k(int q) { if (q) { q--; } }") == ["void k(int q) { if (q) { q--; } }"]


def test_callees_do_not_depend_on_blanks(spark):
    """Bodies are searched as they stand; only those whose blanks matter to a callee are squeezed."""
    bodies = [
        "a.  b(1); c ->\n d(2); e >  f(3);", "x = (*p)\n\n(1); g\t(2);", "if  (a)  h (1);\nreturn\n\n k(2);", "a . b (c\n.\td(1));",
        "(  *  fp ) ( 1 );  return  (  *q )(2);", "m[a[b]]  (1); f(1)  ->  g(2);", "x >\n\ny(1); z(2);", "plain(1);\n  other(2);\r\n",
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    own, squeezed = clex.call_names(F.col("b")), clex.call_names(clex.squeezed(F.col("b")))
    for r in df.select("b", own.alias("own"), squeezed.alias("squeezed")).collect():
        assert r.own == r.squeezed and r.own, r.b
    code = spark.createDataFrame([("int  f ( void )\n{\n  if (a)  return  g(1);\n}",)], "function_code string")
    counts = X.function_facts(code).select("return_count")
    assert "regexp_replace" in counts._jdf.queryExecution().optimizedPlan().toString()
    assert r"\G((?:\S+" not in counts._jdf.queryExecution().optimizedPlan().toString()


def test_tokens_of_a_tree_are_found_without_an_object_for_each():
    from codeloom.functions import treeheight

    assert treeheight._TOKEN.groups == 1
    code = "a->b /* c */ <<= .5e+1 . x ... 'q' \"s\\\"\" // d\n \t[1] - -- @ sizeof é"
    leaves = {"a", "b", ".5e+1", "x", "'q'", '"s\\""', "1", "sizeof"}
    found = ["a", "->", "b", "<<=", ".5e+1", ".", "x", "...", "'q'", '"s\\""', "[", "1", "]", "-", "--", "sizeof"]
    assert treeheight._tokens(code) == [(t, t in leaves) for t in found]
    branches = "#if A\na\n#elif B\nb\n#else\nc\n#endif\nd"
    assert treeheight._tokens(branches) == [("a", True), ("d", True)]
