"""C source text derived row by row from the given tables.

The tables hold no C code, so the extraction operators read files that a
projection writes from each row: the row fixes every count, which makes the
expected result plain arithmetic over the same table. One row gives one file, so
deriving the text needs no grouping and no key can become hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HEAD = (
    "#include <a.h>\n#define MAX(a, b) \\\n  ((a) > (b) ? { (a) : (b))\n\n"
    "struct S { int z; };\nstatic int t[] = {1, 2};\nint proto(int);\n\n"
)


def lineitem_path() -> Column:
    """Path of the file that stands for a ``lineitem`` row."""
    return F.format_string(
        "o%d/l%d_p%d_s%d_q%d_x%d.c",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("int"),
        F.round(F.col("l_extendedprice") * 100).cast("long"),
    )


def sources_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One C file per row with ``l_linenumber % 4`` function definitions, and two more where it is 3."""
    q = F.col("l_quantity").cast("int")
    tag = F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))

    def times(text: str, n: Column) -> Column:
        return F.repeat(F.lit(text), n.cast("int"))

    def once(text: str, condition: Column) -> Column:
        return F.when(condition, F.lit(text)).otherwise("")

    pointer_function = F.concat(
        F.lit("static int *fn_"), tag, F.lit("(int a1"),
        once(", int a2", q % 3 >= 1), once(", int a3", q % 3 >= 2), F.lit(")\n{\n"),
        F.lit("  /* if( { */\n"),
        times("  if (a1) { gpio_set_level(a1, 1); }\n", q % 4),
        times('  for (;;) { x = "{"; }\n', q % 2),
        once("  p = malloc(4);\n", q % 5 == 0),
        F.lit("  return 0;\n}\n"),
    )
    handler = F.concat(
        F.lit("\nvoid IRAM_ATTR isr_"), tag, F.lit("(void) {\n"),
        F.lit("  // while (1) { free(p); }\n"),
        times("  do { n--; } while (n > 0);\n", q % 3),
        times("  while (n < '}') { n++; }\n", q % 2),
        once("  switch (n) { case 1: break; default: dev->ops.run(n); }\n", q % 4 == 1),
        once("  (*cb)(n);\n", q % 7 == 0),
        times('  if (n) { goto out; } else if (m) { printf("%d \\"{\\n", n); }\n', q % 3),
        F.lit("out:\n  n = 0;\n}\n"),
    )
    conditional = F.concat(
        F.lit("\nunsigned long calc_"), tag,
        F.lit("(const char *s, struct node **t, int (*cmp)(int, int))\n{\n"),
        F.lit("  char *p1 = zalloc(8), **p2;\n"),
        F.lit("#ifdef DEBUG\n  if (s) {\n#else\n  if (t) {\n#endif\n    tab[q]((int)(x));\n  }\n"),
        times("  for (int i = 0; i < 3; i++) { continue; }\n", q % 3),
        F.lit("  return sizeof(x) + foo(bar(1));\n}\n"),
    )
    old_style = F.concat(
        F.lit("\nlong old_"), tag, F.lit("(a, b)\n  int a;\n  char *b;\n{\n  m[a[b[c]]](1);\n"),
        times("  (*get(a))(b);\n", q % 3),
        F.lit("  return ((T)(b))->fn(3) + f(1)->g(2);\n}\n"),
    )
    returns_function = F.concat(
        F.lit("\nint (*pick_"), tag, F.lit("(int a, int b))(void) NOEXCEPT\n#ifdef X\n#endif\n{\n"),
        F.lit("  if (a) ((T *)b)->run(k(4));\n  return 0;\n}\n"),
    )
    n = F.col("l_linenumber") % 4
    return lineitem.select(
        lineitem_path().alias("file_path"),
        F.concat(
            F.lit(_HEAD),
            F.when(n >= 1, pointer_function).otherwise(""),
            F.when(n >= 2, handler).otherwise(""),
            F.when(n >= 3, F.concat(conditional, old_style, returns_function)).otherwise(""),
            F.lit("int after;\n"),
        ).alias("text"),
    )


WORD = "[A-Za-z_][A-Za-z0-9_]*"


def words(text: Column) -> Column:
    """ASCII words of a text, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def sources_from_documents(documents: DataFrame) -> DataFrame:
    """One C file per document."""
    return documents.select(F.format_string("d%d.c", "doc_id").alias("file_path"), document_code().alias("text"))


def document_code() -> Column:
    """C code of a row of ``documents``: its whole text as a comment and as a string
    literal, and one statement ``word();`` per ASCII word of it."""
    text = F.col("text")
    literal = F.replace(
        F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')),
        F.lit("\n"),
        F.lit("\\n"),
    )
    return F.concat(
        F.lit("/* "), F.replace(text, F.lit("*/"), F.lit("* /")), F.lit(" */\n"),
        F.lit("int doc_"), F.col("doc_id").cast("string"), F.lit("(void)\n{\n"),
        F.lit('const char *s = "'), literal, F.lit('";\n'),
        F.array_join(F.transform(words(text), lambda w: F.concat(w, F.lit("();\n"))), ""),
        F.lit("return 0;\n}\n"),
    )


def sources_from_part(part: DataFrame) -> DataFrame:
    """One C file per row whose statements ``a * b;`` declare or multiply, as type names of all files tell."""
    k = F.col("p_partkey")

    def numbered(name: str, n: Column) -> Column:
        return F.concat(F.lit(name), n.cast("string"))

    fifty = (k % 50).cast("string")
    own = numbered("w_", k)
    return part.select(
        numbered("p", k).alias("file_path"),
        F.concat(
            F.when(k % 3 == 0, F.concat(F.lit("typedef struct cell { int z; struct { int * y; } in; } cell_"), fifty, F.lit(";\n"))).otherwise(""),
            F.when(k % 150 == 1, F.concat(F.lit("typedef unsigned long (*hook_"), fifty, F.lit(")(int, char *);\n"))).otherwise(""),
            F.lit("int use_"), k.cast("string"), F.lit("("), numbered("grid_", k % 7), F.lit(" *g, int "), own, F.lit(")\n{\n  cell_"),
            fifty, F.lit(" * c;\n  hook_"), fifty, F.lit(" * h[2], *i;\n  "),
            own, F.lit(" * g;\n  "), numbered("area_", k), F.lit(" * height;\n  "),
            numbered("node_", k % 11), F.lit(" one;\n  "), numbered("node_", (k + 1) % 11), F.lit(" * two;\n  "),
            numbered("grid_", (k + 3) % 7), F.lit(" ** q;\n  uint8_t * r;\n  int * sure = 0;\n  return 0;\n}\n"),
        ).alias("text"),
    )
