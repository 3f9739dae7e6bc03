"""The registered queries as SQL over the same tables, written independently of
the operators: the derived C files are never parsed here, their counts follow by
arithmetic from the rows that produced them."""

from __future__ import annotations

# --- the derived function table ---------------------------------------------------

# Words of the C grammar that are no callee.
_NON_CALLS = (
    "if for while switch return do else case goto sizeof _Alignof alignof __alignof__ "
    "offsetof _Generic typeof __typeof__ _Static_assert static_assert asm __asm__ __asm "
    "__attribute__ __attribute __declspec void char short int long float double signed "
    "unsigned bool _Bool struct union enum const volatile static extern register inline typedef"
).split()
_NON_CALL_LIST = "[" + ", ".join(f"'{w}'" for w in _NON_CALLS) + "]"

_WORDS = "regexp_extract_all(text, '[A-Za-z_][A-Za-z0-9_]*')"


def _times(name: str, n: str) -> str:
    return f"list_transform(range({n}), lambda x: '{name}')"


def _word_count(word: str) -> str:
    return f"len(list_filter(w, lambda x: x = '{word}'))"


_FLOW = {
    "break": _word_count("break"),
    "continue": _word_count("continue"),
    "do_while": _word_count("do"),
    "for": _word_count("for"),
    "goto": _word_count("goto"),
    "if": _word_count("if"),
    "return": "1",
    "switch": _word_count("switch"),
    "while": f"{_word_count('while')} - {_word_count('do')}",
}
_DOC_FLOW = (
    "array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN {n} > 0 THEN '{k}' END" for k, n in _FLOW.items())
    + "], lambda x: x IS NOT NULL), ',')"
)

FUNCTIONS = f"""
files AS (
  SELECT 'o' || l_orderkey || '/l' || l_linenumber || '_p' || l_partkey || '_s' || l_suppkey
         || '_q' || CAST(l_quantity AS INTEGER)
         || '_x' || CAST(round(l_extendedprice * 100) AS BIGINT) || '.c' AS file_path,
         CAST(l_quantity AS INTEGER) AS q, l_linenumber % 4 AS n,
         l_orderkey || '_' || l_linenumber AS tag
  FROM lineitem),
line_functions AS (
  SELECT files.*, j FROM files, (VALUES (1), (2), (3), (4), (5)) AS u(j) WHERE j <= n OR n = 3),
doc_words AS (SELECT doc_id, text, {_WORDS} AS w FROM documents),
fns AS (
  SELECT file_path, j AS fn_no,
    CASE j WHEN 1 THEN 'fn_' || tag WHEN 2 THEN 'isr_' || tag WHEN 3 THEN 'calc_' || tag
         WHEN 4 THEN 'old_' || tag ELSE '(*pick_' || tag || '(int a, int b))' END AS function_name,
    CASE j WHEN 1 THEN q % 4 WHEN 2 THEN 2 * (q % 3) WHEN 3 THEN 2 WHEN 4 THEN 0 ELSE 1 END AS if_count,
    CASE j WHEN 1 THEN q % 2 WHEN 2 THEN q % 3 + q % 2 WHEN 3 THEN q % 3 ELSE 0 END AS loop_count,
    CASE j WHEN 2 THEN 0 ELSE 1 END AS return_count,
    CASE j WHEN 1 THEN
           CASE WHEN q % 4 > 0 THEN 3 WHEN q % 2 > 0 OR q % 5 = 0 THEN 2 ELSE 1 END
         WHEN 2 THEN
           CASE WHEN q % 4 = 1 OR q % 3 > 0 THEN 3 WHEN q % 2 > 0 OR q % 7 = 0 THEN 2 ELSE 1 END
         WHEN 3 THEN 5 WHEN 4 THEN 4 ELSE 3 END AS nesting_depth,
    CASE j WHEN 1 THEN 5 + q % 4 + q % 2 + CAST(q % 5 = 0 AS INTEGER)
         WHEN 2 THEN 5 + 2 * (q % 3) + q % 2 + CAST(q % 4 = 1 AS INTEGER) + CAST(q % 7 = 0 AS INTEGER)
         WHEN 3 THEN 12 + q % 3 WHEN 4 THEN 7 + q % 3 ELSE 7 END AS line_count,
    CASE j WHEN 1 THEN 1 + q % 3 WHEN 2 THEN 1 WHEN 3 THEN 3 WHEN 4 THEN 2 ELSE 1 END AS param_count,
    CASE j WHEN 2 THEN 0 WHEN 3 THEN 7 ELSE 1 END AS pointer_count,
    CASE j WHEN 1 THEN
           (CASE WHEN q % 2 > 0 THEN 'for,' ELSE '' END)
           || (CASE WHEN q % 4 > 0 THEN 'if,' ELSE '' END) || 'return'
         WHEN 2 THEN array_to_string(list_filter([
             CASE WHEN q % 4 = 1 THEN 'break' END, CASE WHEN q % 3 > 0 THEN 'do_while' END,
             CASE WHEN q % 3 > 0 THEN 'goto' END, CASE WHEN q % 3 > 0 THEN 'if' END,
             CASE WHEN q % 4 = 1 THEN 'switch' END, CASE WHEN q % 2 > 0 THEN 'while' END
           ], lambda x: x IS NOT NULL), ',')
         WHEN 3 THEN (CASE WHEN q % 3 > 0 THEN 'continue,for,' ELSE '' END) || 'if,return'
         WHEN 4 THEN 'return' ELSE 'if,return' END AS control_flow,
    CASE j WHEN 1 THEN list_concat({_times('gpio_set_level', 'q % 4')},
             CASE WHEN q % 5 = 0 THEN ['malloc'] ELSE [] END)
         WHEN 2 THEN list_concat(list_concat(
             CASE WHEN q % 4 = 1 THEN ['dev->ops.run'] ELSE [] END,
             CASE WHEN q % 7 = 0 THEN ['(*cb)'] ELSE [] END), {_times('printf', 'q % 3')})
         WHEN 3 THEN ['zalloc', 'tab[q]', 'foo', 'bar']
         WHEN 4 THEN list_concat(list_concat(['m[a[b[c]]]'],
             flatten(list_transform(range(q % 3), lambda x: ['(*get(a))', 'get']))),
             ['((T)(b))->fn', 'f(1)->g', 'f'])
         ELSE ['((T*)b)->run', 'k'] END AS calls,
    CASE j WHEN 1 THEN
           'static int *fn_' || tag || '(int a1' || (CASE WHEN q % 3 >= 1 THEN ', int a2' ELSE '' END)
           || (CASE WHEN q % 3 >= 2 THEN ', int a3' ELSE '' END) || ')' || chr(10) || '{{' || chr(10)
           || '  /* if( {{ */' || chr(10)
           || repeat('  if (a1) {{ gpio_set_level(a1, 1); }}' || chr(10), q % 4)
           || repeat('  for (;;) {{ x = "{{"; }}' || chr(10), q % 2)
           || (CASE WHEN q % 5 = 0 THEN '  p = malloc(4);' || chr(10) ELSE '' END)
           || '  return 0;' || chr(10) || '}}'
         WHEN 2 THEN
           'void IRAM_ATTR isr_' || tag || '(void) {{' || chr(10)
           || '  // while (1) {{ free(p); }}' || chr(10)
           || repeat('  do {{ n--; }} while (n > 0);' || chr(10), q % 3)
           || repeat('  while (n < ''}}'') {{ n++; }}' || chr(10), q % 2)
           || (CASE WHEN q % 4 = 1 THEN
               '  switch (n) {{ case 1: break; default: dev->ops.run(n); }}' || chr(10) ELSE '' END)
           || (CASE WHEN q % 7 = 0 THEN '  (*cb)(n);' || chr(10) ELSE '' END)
           || repeat('  if (n) {{ goto out; }} else if (m) {{ printf("%d \\"{{\\n", n); }}' || chr(10), q % 3)
           || 'out:' || chr(10) || '  n = 0;' || chr(10) || '}}'
         WHEN 4 THEN
           'long old_' || tag || '(a, b)' || chr(10) || '  int a;' || chr(10) || '  char *b;' || chr(10)
           || '{{' || chr(10) || '  m[a[b[c]]](1);' || chr(10)
           || repeat('  (*get(a))(b);' || chr(10), q % 3)
           || '  return ((T)(b))->fn(3) + f(1)->g(2);' || chr(10) || '}}'
         WHEN 5 THEN
           'int (*pick_' || tag || '(int a, int b))(void) NOEXCEPT' || chr(10) || '#ifdef X' || chr(10)
           || '#endif' || chr(10) || '{{' || chr(10) || '  if (a) ((T *)b)->run(k(4));' || chr(10)
           || '  return 0;' || chr(10) || '}}'
         ELSE
           'unsigned long calc_' || tag || '(const char *s, struct node **t, int (*cmp)(int, int))'
           || chr(10) || '{{' || chr(10) || '  char *p1 = zalloc(8), **p2;' || chr(10)
           || '#ifdef DEBUG' || chr(10) || '  if (s) {{' || chr(10) || '#else' || chr(10)
           || '  if (t) {{' || chr(10) || '#endif' || chr(10) || '    tab[q]((int)(x));' || chr(10)
           || '  }}' || chr(10)
           || repeat('  for (int i = 0; i < 3; i++) {{ continue; }}' || chr(10), q % 3)
           || '  return sizeof(x) + foo(bar(1));' || chr(10) || '}}'
         END AS code
  FROM line_functions
  UNION ALL
  SELECT 'd' || doc_id || '.c', 1, 'doc_' || doc_id,
    {_word_count('if')}, {_word_count('for')} + {_word_count('while')},
    1 + {_word_count('return')},
    CASE WHEN len(w) > 0 THEN 2 ELSE 1 END,
    5 + len(w), 1, 1, {_DOC_FLOW},
    list_filter(w, lambda x: NOT list_contains({_NON_CALL_LIST}, x)),
    'int doc_' || doc_id || '(void)' || chr(10) || '{{' || chr(10) || 'const char *s = "'
      || replace(replace(replace(text, chr(92), chr(92) || chr(92)), '"', chr(92) || '"'),
                 chr(10), chr(92) || 'n')
      || '";' || chr(10)
      || array_to_string(list_transform(w, lambda x: x || '();' || chr(10)), '')
      || 'return 0;' || chr(10) || '}}'
  FROM doc_words),
f AS (
  SELECT *, file_path || '#' || fn_no AS function_id, len(calls) AS call_count,
    list_contains(calls, 'malloc') OR list_contains(calls, 'free') OR list_contains(calls, 'realloc')
      OR list_contains(calls, 'calloc') AS is_memory,
    len(list_filter(calls, lambda x: list_contains(['printf', 'fprintf', 'fwrite', 'fread', 'write',
      'read', 'fopen', 'fclose', 'puts', 'fputs'], x))) > 0 AS is_io,
    len(list_filter(calls, lambda x: regexp_matches(x,
      '^(HAL_|gpio_|uart_|spi_|i2c_|ledc_|adc_|rmt_|timer_|esp_rom_gpio|REG_WRITE$|REG_READ$)'))) > 0
      AS is_hardware
  FROM fns),
g AS (
  SELECT *, array_to_string(list_filter([CASE WHEN is_hardware THEN 'hardware' END,
    CASE WHEN is_io THEN 'io' END, CASE WHEN is_memory THEN 'memory' END],
    lambda x: x IS NOT NULL), ',') AS effects FROM f)
"""


def _from_functions(select: str, source: str = "g") -> str:
    return f"WITH {FUNCTIONS} SELECT {select} FROM {source}"


# --- labelled vectors -------------------------------------------------------------

_LABELS = """
  CASE WHEN label % 2 <> 0 AND label % 3 <> 0 AND label % 5 <> 0 THEN ['none'] ELSE
    list_concat(list_concat(CASE WHEN label % 2 = 0 THEN ['hardware'] ELSE [] END,
      CASE WHEN label % 3 = 0 THEN ['io'] ELSE [] END),
      CASE WHEN label % 5 = 0 THEN ['memory'] ELSE [] END) END"""

VECTORS = f"""
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, {_LABELS} AS labels FROM embeddings)
"""

HITS = f"""
{VECTORS},
sims AS MATERIALIZED (
  SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, a.labels AS query_labels,
         b.labels AS neighbour_labels,
         round(list_inner_product(a.e, b.e)
               / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)), 9) AS similarity
  FROM v a, v b WHERE a.vec_id <> b.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, neighbour_id) AS rank
  FROM sims),
hits AS MATERIALIZED (
  SELECT *, len(list_intersect(query_labels, neighbour_labels)) > 0 AS rel
  FROM ranked WHERE rank <= 5),
relevant AS MATERIALIZED (
  SELECT a.vec_id AS query_id,
         CAST(sum(CASE WHEN a.vec_id <> b.vec_id AND len(list_intersect(a.labels, b.labels)) > 0
                  THEN 1 ELSE 0 END) AS BIGINT) AS n_relevant
  FROM v a, v b GROUP BY a.vec_id),
per_query AS MATERIALIZED (
  SELECT r.query_id, n_relevant,
    coalesce(max(CASE WHEN rel THEN 1.0 / rank END), 0.0) AS mrr,
    CASE WHEN n_relevant > 0 THEN
      sum(CASE WHEN rel AND rank <= 3 THEN 1 ELSE 0 END)::DOUBLE / least(n_relevant, 3) ELSE 0.0 END AS r3,
    CASE WHEN n_relevant > 0 THEN
      sum(CASE WHEN rel THEN 1 ELSE 0 END)::DOUBLE / least(n_relevant, 5) ELSE 0.0 END AS r5
  FROM relevant r LEFT JOIN hits h ON r.query_id = h.query_id
  GROUP BY r.query_id, n_relevant)
"""

_CLASSES = ["hardware", "io", "memory", "none"]


def _list(values: list[float]) -> str:
    return "[" + ", ".join(repr(float(x)) for x in values) + "]"


def _weights(c: int, dims: range) -> list[float]:
    return [((i * 7 + c * 3) % 11 - 5) / 10 for i in dims]


_PREDICTED_CASES = ", ".join(
    f"CASE WHEN list_inner_product(e, {_list(_weights(c, range(64)))}) + {(c - 1) / 10} > 0 "
    f"THEN '{name}' END"
    for c, name in enumerate(_CLASSES)
)
PREDICTED = f"""
{VECTORS},
chosen AS (SELECT *, list_filter([{_PREDICTED_CASES}], lambda x: x IS NOT NULL) AS c FROM v),
predicted AS (
  SELECT vec_id, labels, CASE WHEN len(c) > 0 THEN c ELSE ['none'] END AS predicted FROM chosen)
"""

_CLASS_ROWS = ", ".join(f"('{c}')" for c in _CLASSES)
REPORT = f"""
{PREDICTED},
counts AS (
  SELECT class,
    sum(CASE WHEN list_contains(labels, class) AND list_contains(predicted, class) THEN 1 ELSE 0 END) AS tp,
    sum(CASE WHEN NOT list_contains(labels, class) AND list_contains(predicted, class) THEN 1 ELSE 0 END) AS fp,
    sum(CASE WHEN list_contains(labels, class) AND NOT list_contains(predicted, class) THEN 1 ELSE 0 END) AS fn
  FROM predicted, (VALUES {_CLASS_ROWS}) AS c(class) GROUP BY class),
per_class AS (
  SELECT class, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1,
    CAST(tp + fn AS BIGINT) AS support FROM counts),
sizes AS (
  SELECT len(list_intersect(labels, predicted)) AS b, len(labels) AS t, len(predicted) AS p
  FROM predicted),
report AS (
  SELECT * FROM per_class
  UNION ALL
  SELECT 'micro avg', coalesce(sum(tp) / nullif(sum(tp + fp), 0), 0.0),
    coalesce(sum(tp) / nullif(sum(tp + fn), 0), 0.0),
    coalesce(2 * sum(tp) / nullif(sum(2 * tp + fp + fn), 0), 0.0), CAST(sum(tp + fn) AS BIGINT)
  FROM counts
  UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per_class
  UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class
  UNION ALL
  SELECT 'samples avg', avg(b / p), avg(b / t), avg(2 * b / (t + p)), CAST(sum(t) AS BIGINT) FROM sizes)
"""

_CENTROIDS = [[((i * 5 + j * 7) % 9 - 4) / 20 for i in range(64)] for j in range(3)]
_DISTANCES = ", ".join(
    f"round(list_inner_product({_list(c)}, {_list(c)}) - 2 * list_inner_product(e, {_list(c)}), 9)"
    for c in _CENTROIDS
)
PROFILE = f"""
{VECTORS},
assigned AS (SELECT *, [{_DISTANCES}] AS d FROM v),
clustered AS (
  SELECT vec_id, labels, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS cluster,
    CASE WHEN list_contains(labels, 'hardware') THEN 'hardware' WHEN list_contains(labels, 'io') THEN 'io'
         WHEN list_contains(labels, 'memory') THEN 'memory' ELSE 'none' END AS dominant
  FROM assigned),
cells AS (
  SELECT cluster, dominant, count(*) AS n,
    list_position(['hardware', 'io', 'memory', 'none'], dominant) AS r
  FROM clustered GROUP BY cluster, dominant),
tops AS (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, r) AS o FROM cells),
profile AS (
  SELECT k.cluster, CAST(coalesce(sum(n), 0) AS BIGINT) AS size,
    coalesce(max(CASE WHEN o = 1 THEN dominant END), '?') AS dominant_label,
    coalesce(round(max(CASE WHEN o = 1 THEN n END) / sum(n), 3), 0.0) AS purity,
    coalesce(string_agg(dominant || '=' || n, ',' ORDER BY dominant), '') AS distribution,
    coalesce(max(n), 0) AS top
  FROM (VALUES (0), (1), (2)) AS k(cluster) LEFT JOIN tops t ON k.cluster = t.cluster
  GROUP BY k.cluster)
"""

# --- fused fixture ----------------------------------------------------------------

_FEATURES = [
    "if_count", "loop_count", "return_count", "call_count",
    "nesting_depth", "line_count", "param_count", "pointer_count",
]


def _occurrences(part: str) -> str:
    return f"length(text) - length(replace(text, {part}, ''))"


FUSED = f"""
{VECTORS},
counts AS (
  SELECT doc_id, {_occurrences("'a'")} AS if_count, {_occurrences("'e'")} AS loop_count,
    {_occurrences("'.'")} AS return_count, len({_WORDS}) AS call_count,
    {_occurrences("' '")} AS nesting_depth, {_occurrences("chr(10)")} + 1 AS line_count,
    {_occurrences("','")} AS param_count, length(text) AS pointer_count
  FROM documents),
joined AS (
  SELECT coalesce(vec_id, doc_id) AS vec_id,
    coalesce(e, list_transform(range(64), lambda i: ((doc_id * 31 + i * 17) % 129 - 64) / 64)) AS e,
    {", ".join(f"coalesce({f}, 0) AS {f}" for f in _FEATURES)}
  FROM v FULL JOIN counts ON vec_id = doc_id),
params AS (
  SELECT {", ".join(f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) = 0 THEN 1.0 ELSE stddev_pop({f}) END AS s_{f}" for f in _FEATURES)}
  FROM joined),
fused AS (
  SELECT vec_id, list_concat(e, [{", ".join(f"({f} - m_{f}) / s_{f}" for f in _FEATURES)}]) AS x
  FROM joined, params)
"""

# Occurrences of the letters a to p in the code, in eighths.
_LETTERS = [f"(length(code) - length(replace(code, '{chr(97 + i)}', ''))) / 8" for i in range(16)]
_SCORES = ", ".join(
    "CASE WHEN "
    + " + ".join(f"({w}) * {x}" for w, x in zip(_weights(c, range(16)), _LETTERS))
    + " + "
    + " + ".join(
        f"({w}) * ({f} - m_{f}) / s_{f}" for w, f in zip(_weights(c, range(16, 24)), _FEATURES)
    )
    + f" + ({(c - 1) / 10}) > 0 THEN '{name}' END"
    for c, name in enumerate(_CLASSES)
)
SCORED = f"""
{FUNCTIONS},
params AS MATERIALIZED (
  SELECT {", ".join(f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) = 0 THEN 1.0 ELSE stddev_pop({f}) END AS s_{f}" for f in _FEATURES)}
  FROM g),
raw AS MATERIALIZED (
  SELECT g.*, list_filter([{_SCORES}], lambda x: x IS NOT NULL) AS c FROM g, params),
scored AS MATERIALIZED (
  SELECT *, CASE WHEN len(c) > 0 THEN c ELSE ['none'] END AS predicted,
    CASE WHEN effects <> '' THEN string_split(effects, ',') WHEN len(calls) = 0 THEN ['none']
         WHEN length(@EFFECTS@) % 2 = 1 THEN ['memory'] ELSE ['io'] END AS ruled FROM raw)
"""

# --- tokens -----------------------------------------------------------------------

_ESC = r"\\(?:\r\n|[\s\S])"
_LINE = rf"//[^\n\\]*(?:{_ESC}[^\n\\]*)*"
_BLOCK = r"/\*[^*]*\*+(?:[^/*][^*]*\*+)*/"
_STR = rf'"[^"\\\n]*(?:{_ESC}[^"\\\n]*)*"'
_CHR = rf"'[^'\\\n]*(?:{_ESC}[^'\\\n]*)*'"
_DIR = rf'#(?:[^\n\\/"]+|{_ESC}|{_BLOCK}|{_LINE}|{_STR}|[/"])*'
_TOKEN = "|".join(
    [
        _LINE, _BLOCK, _DIR, _STR, _CHR, r"[A-Za-z_]\w*", r"\.?[0-9](?:[eEpP][+\-]|[\w.])*",
        "->", r"[ \t\n\x0B\f\r]+", r"[\s\S]",
    ]
).replace("'", "''")

_LINE_COLUMNS = {
    "l_quantity": "l_quantity",
    "l_extendedprice": "l_extendedprice",
    "l_discount": "l_discount",
    "l_tax": "l_tax",
    "constant": "5.0",
}


def _scaler_rows(extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feature, round(avg({col}), 4) AS mean, "
        f"round(CASE WHEN stddev_pop({col}) = 0 THEN 1.0 ELSE stddev_pop({col}) END, 4) AS std{extra} "
        "FROM lineitem"
        for name, col in _LINE_COLUMNS.items()
    )


def _histogram(name: str, col: str) -> str:
    return f"""
  SELECT '{name}' AS "column", CAST(b AS INTEGER) AS bin,
    round(lo + (hi - lo) / 30 * (b - 1), 3) AS lo, round(lo + (hi - lo) / 30 * b, 3) AS hi,
    count(bin) AS n
  FROM (SELECT CASE WHEN min({col}) = max({col}) THEN min({col}) - 0.5 ELSE min({col}) END::DOUBLE AS lo,
               CASE WHEN min({col}) = max({col}) THEN max({col}) + 0.5 ELSE max({col}) END::DOUBLE AS hi
        FROM lineitem) r
  CROSS JOIN range(1, 31) AS bins(b)
  LEFT JOIN (
    SELECT least(floor(30.0 * ({col} - lo2) / (hi2 - lo2)) + 1, 30) AS bin
    FROM lineitem, (
      SELECT CASE WHEN min({col}) = max({col}) THEN min({col}) - 0.5 ELSE min({col}) END::DOUBLE AS lo2,
             CASE WHEN min({col}) = max({col}) THEN max({col}) + 0.5 ELSE max({col}) END::DOUBLE AS hi2
      FROM lineitem) r2) x ON x.bin = b
  GROUP BY b, lo, hi"""


def _describe(name: str, col: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS \"column\", count({col}) AS \"count\", round(avg({col}), 2) AS mean, "
        f"round(stddev_samp({col}), 2) AS std, round(min({col})::DOUBLE, 2) AS \"min\", "
        f"round(quantile_cont({col}::DOUBLE, 0.25), 2) AS q25, round(quantile_cont({col}::DOUBLE, 0.5), 2) AS q50, "
        f"round(quantile_cont({col}::DOUBLE, 0.75), 2) AS q75, round(max({col})::DOUBLE, 2) AS \"max\" FROM {source}"
    )


_KIND = "['io', 'memory', 'hardware', 'none', 'disk'][user_id % 5 + 1]"

_EFFECTS_PROMPT = (
    "'You are an expert in embedded C. Analyze this function and identify its side effects. "
    "A side effect is an observable interaction beyond the return value:' || chr(10) || "
    "'  - io: file/serial/log operations' || chr(10) || "
    "'  - memory: heap allocation or deallocation' || chr(10) || "
    "'  - hardware: GPIO, UART, SPI, register access, interrupts' || chr(10) || "
    "'  - none: pure computation, no external interaction' || chr(10) || chr(10) || "
    "'Function:' || chr(10) || code || chr(10) || chr(10) || "
    "'Respond ONLY with valid JSON, no other text:' || chr(10) || "
    "'{\"side_effects\": [\"io\"|\"memory\"|\"hardware\"|\"none\"]}'"
)
_PURPOSE_PROMPT = (
    "'You are analyzing embedded C code. Given this function:' || chr(10) || '<code>' || chr(10) || "
    "code || chr(10) || '</code>' || chr(10) || chr(10) || 'Think step by step:' || chr(10) || "
    "'1. What is the primary responsibility of this function?' || chr(10) || "
    "'2. What does it set up, compute, or control?' || chr(10) || "
    "'3. Who would call this function and why?' || chr(10) || chr(10) || 'Write your reasoning.'"
)
_SECOND = (
    "'Based on your reasoning, write ONE concise sentence describing what this function does. "
    "Start with a verb. No JSON, just the sentence.'"
)

SCORED = SCORED.replace("@EFFECTS@", _EFFECTS_PROMPT)

_WORD_EFFECTS = f"""
  SELECT doc_id, len(w) AS n_words, array_to_string(list_filter([
    CASE WHEN len(list_filter(w, lambda x: x IN ('der', 'la') OR starts_with(x, 'hard'))) > 0
         THEN 'hardware' END,
    CASE WHEN len(list_filter(w, lambda x: x IN ('and', 'to') OR starts_with(x, 'st')
         OR starts_with(x, 'pr'))) > 0 THEN 'io' END,
    CASE WHEN len(list_filter(w, lambda x: x IN ('the', 'de', 'und') OR starts_with(x, 'me'))) > 0
         THEN 'memory' END], lambda x: x IS NOT NULL), ',') AS effects
  FROM (SELECT doc_id, {_WORDS} AS w FROM documents)"""

_SIGNAL_ROWS = """
signals(label, kind, pattern) AS (
  SELECT 'memory', 'exact', unnest(string_split('malloc free realloc calloc heap_caps_malloc heap_caps_free heap_caps_calloc heap_caps_realloc pvPortMalloc vPortFree', ' '))
  UNION ALL
  SELECT 'io', 'exact', unnest(string_split('printf fprintf fwrite fread write read fopen fclose puts fputs ESP_LOGI ESP_LOGE ESP_LOGW ESP_LOGD ESP_LOGV esp_log_write uart_write_bytes uart_read_bytes', ' '))
  UNION ALL
  SELECT 'hardware', 'exact', unnest(string_split('gpio_set_level gpio_get_level gpio_config gpio_set_direction gpio_set_pull_mode uart_param_config uart_driver_install uart_driver_delete spi_bus_initialize spi_bus_free spi_device_transmit i2c_master_cmd_begin i2c_master_start i2c_master_stop REG_WRITE REG_READ WRITE_PERI_REG READ_PERI_REG SET_PERI_REG_MASK CLEAR_PERI_REG_MASK esp_rom_gpio_pad_select_gpio ledc_set_duty ledc_update_duty adc1_get_raw adc2_get_raw rmt_write_items rmt_rx_start rmt_tx_start timer_set_counter_value timer_start timer_pause esp_intr_alloc esp_intr_free esp_intr_enable esp_intr_disable', ' '))
  UNION ALL
  SELECT 'hardware', 'prefix', unnest(string_split('HAL_ gpio_ uart_ spi_ i2c_ ledc_ adc_ rmt_ timer_ esp_rom_gpio', ' ')))
"""

_MEASURED = (
    "CASE WHEN length(text) % 7 <> 0 THEN CAST(length(text) AS VARCHAR) END AS value, "
    "CASE WHEN length(text) % 7 = 0 THEN 'ValueError: length divisible by seven' END AS error"
)

ORACLES: dict[str, str] = {
    "src1_read_sources": "SELECT md5(text) AS digest, CAST(length(text) AS INTEGER) AS n_chars FROM documents",
    "src2_read_functions": _from_functions(
        "function_id, fn_no, function_name, CAST(call_count AS INTEGER) AS call_count, control_flow, "
        "md5(array_to_string(calls, '|')) AS calls_digest, true AS unlabelled"
    ),
    "src3_write_functions": _from_functions(
        "CASE WHEN effects = '' AND call_count > 0 THEN 'llm_fallback' ELSE 'deterministic' END "
        "AS side_effects_source, effects, count(*) AS n"
    )
    + " GROUP BY ALL",
    "src4_write_snapshot": "SELECT doc_id, lang, n_chars * 2 AS n_chars FROM documents",
    "src4_claimed_versions": "SELECT doc_id, n_chars + 3 AS n_chars, 3 AS version FROM documents",
    "src5_save_vectors_and_labels": f"WITH {VECTORS} SELECT vec_id, CAST(len(e) AS INTEGER) AS dim, "
    "round(list_inner_product(e, e), 4) AS norm, array_to_string(labels, ',') AS labels FROM v",
    "src6_model_tables": _scaler_rows(", 4 AS n_classes"),
    "src7_write_metrics": "SELECT l_returnflag AS name, round(avg(l_quantity), 4) AS value, count(*) AS n "
    "FROM lineitem GROUP BY l_returnflag",
    "ext1_tokenize_sources": f"""
WITH t AS (
  SELECT CAST(doc_id AS VARCHAR) AS file_path, unnest(k) AS tok, generate_subscripts(k, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '{_TOKEN}') AS k FROM documents)),
p AS (
  SELECT *, coalesce(sum(length(tok)) OVER w, 0) AS off,
    1 + coalesce(sum(length(tok) - length(replace(tok, chr(10), ''))) OVER w, 0) AS line
  FROM t
  WINDOW w AS (PARTITION BY file_path ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT file_path, count(*) AS n_tokens, CAST(sum(off) AS BIGINT) AS sum_off,
  CAST(sum(line) AS BIGINT) AS sum_line, CAST(max(length(tok)) AS INTEGER) AS longest
FROM p GROUP BY file_path""",
    "ext2_extract_functions": _from_functions("function_id, file_path, fn_no, md5(code) AS code_digest"),
    "ext3_function_name": _from_functions("function_id, function_name"),
    **{
        f"ext{n}_{f}": _from_functions(f"function_id, CAST({f} AS INTEGER) AS {f}")
        for n, f in (
            (4, "if_count"), (5, "loop_count"), (6, "return_count"), (7, "call_count"),
            (8, "pointer_count"), (9, "param_count"), (10, "line_count"), (11, "nesting_depth"),
        )
    },
    "ext8_pointers_by_types": """
WITH p AS (SELECT p_partkey AS k FROM part),
cells AS (SELECT DISTINCT k % 50 AS r FROM p WHERE k % 3 = 0), hooks AS (SELECT DISTINCT k % 50 AS r FROM p WHERE k % 150 = 1),
nodes AS (SELECT DISTINCT k % 11 AS r FROM p), grids AS (SELECT DISTINCT k % 7 AS r FROM p)
SELECT 'p' || k || '#1' AS function_id, CAST(3
  + CASE WHEN k % 50 IN (SELECT r FROM cells) THEN 1 ELSE 0 END
  + CASE WHEN k % 50 IN (SELECT r FROM hooks) THEN 2 ELSE 0 END
  + CASE WHEN (k + 1) % 11 IN (SELECT r FROM nodes) THEN 1 ELSE 0 END
  + CASE WHEN (k + 3) % 7 IN (SELECT r FROM grids) THEN 2 ELSE 0 END AS INTEGER) AS pointer_count
FROM p""",
    "ext11_tree_height": f"""
WITH {FUNCTIONS.split("doc_words AS")[0].rstrip().rstrip(",")}
SELECT file_path || '#' || j AS function_id, CAST(CASE j
  WHEN 1 THEN CASE WHEN q % 4 > 0 THEN 7 WHEN q % 5 = 0 THEN 6 ELSE 4 END
  WHEN 2 THEN CASE WHEN q % 3 > 0 OR q % 4 = 1 THEN 9 WHEN q % 2 > 0 OR q % 7 = 0 THEN 6 ELSE 5 END
  WHEN 5 THEN 10 ELSE 9 END AS INTEGER) AS tree_height
FROM line_functions""",
    "ext12_control_flow_elements": _from_functions("function_id, control_flow"),
    "ext13_call_names": _from_functions("function_id, md5(array_to_string(calls, '|')) AS calls_digest"),
    "ext14_feature_struct": _from_functions(
        "function_id, " + ", ".join(f"CAST({f} AS INTEGER) AS {f}" for f in _FEATURES)
    ),
    "ext15_functions_per_file": f"WITH {FUNCTIONS} SELECT file_path, CAST(CASE n WHEN 3 THEN 5 ELSE n END AS BIGINT) AS n_functions FROM files "
    "UNION ALL SELECT 'd' || doc_id || '.c', 1 FROM documents",
    "ext16_corpus_stats": _from_functions(
        "count(*) AS n_functions, round(avg(line_count), 4) AS avg_lines, "
        "CAST(max(line_count) AS INTEGER) AS max_lines, "
        "count(*) FILTER (WHERE loop_count > 0) AS with_loops, "
        "count(*) FILTER (WHERE pointer_count > 0) AS with_pointers"
    ),
    "lab1_signal_table": f"WITH {FUNCTIONS}, {_SIGNAL_ROWS}, "
    "used AS (SELECT unnest(list_distinct(calls)) AS name FROM g), "
    "n AS (SELECT name, count(*) AS k FROM used GROUP BY name) "
    "SELECT label, kind, pattern, coalesce(k, 0) AS n_functions FROM signals LEFT JOIN n ON pattern = name",
    "lab2_deterministic_side_effects": _from_functions("function_id, effects"),
    "lab2_side_effects_from_table": f"SELECT doc_id, effects FROM ({_WORD_EFFECTS})",
    "lab3_is_ambiguous": _from_functions(
        "function_id, effects = '' AND call_count > 0 AS is_ambiguous"
    ),
    "lab4_side_effects_source": "SELECT doc_id, CASE WHEN effects = '' AND n_words > 0 THEN 'llm_fallback' "
    f"ELSE 'deterministic' END AS side_effects_source, effects FROM ({_WORD_EFFECTS})",
    "lab5_prompts": f"""
SELECT conv_id, md5({_EFFECTS_PROMPT}) AS prompt_digest,
  md5('user:' || {_PURPOSE_PROMPT} || chr(10) || 'assistant:' || reply || chr(10) || 'user:' || {_SECOND})
    AS messages_digest
FROM (SELECT conv_id,
        coalesce(string_agg(coalesce(text, ''), chr(10) ORDER BY turn) FILTER (turn % 2 = 0), '') AS code,
        coalesce(string_agg(coalesce(text, ''), chr(10) ORDER BY turn) FILTER (turn % 2 = 1), '') AS reply
      FROM conversations GROUP BY conv_id)""",
    "lab_label_functions": f"""
WITH d AS (
  SELECT doc_id, lang, length({_EFFECTS_PROMPT}) % 4 AS r, length({_PURPOSE_PROMPT}) % 5 AS c, len(w) AS n,
    len(list_filter(w, lambda x: x = 'and' OR starts_with(x, 'st'))) > 0 AS has_io
  FROM (SELECT doc_id, lang, text AS code, {_WORDS} AS w FROM documents)),
e AS (
  SELECT *, NOT has_io AND n > 0 AS unclear, (NOT has_io AND n > 0 AND r >= 2) OR c = 0 AS failed FROM d)
SELECT doc_id, lang AS control_flow,
  CASE WHEN failed THEN 'error' WHEN unclear THEN 'llm_fallback' ELSE 'deterministic' END AS side_effects_source,
  CASE WHEN failed THEN 'ERROR' ELSE 'turn 3' END AS purpose,
  CASE WHEN failed THEN 'none' WHEN has_io THEN 'io' WHEN unclear AND r = 0 THEN 'memory' ELSE 'none' END AS effects
FROM e""",
    "lab6_parse_effects_reply": f"""
SELECT event_id,
  CASE event_id % 10
    WHEN 0 THEN CASE WHEN kind = 'disk' THEN 'io' ELSE kind || ',io' END
    WHEN 1 THEN CASE WHEN kind = 'disk' THEN 'none' ELSE kind || ',' || kind END
    WHEN 8 THEN CASE WHEN kind = 'disk' THEN 'none' ELSE kind END
    ELSE 'none' END AS effects,
  CASE event_id % 10
    WHEN 0 THEN 'valid'
    WHEN 1 THEN CASE WHEN kind = 'disk' THEN 'default' ELSE 'valid' END
    WHEN 8 THEN CASE WHEN kind = 'disk' THEN 'default' ELSE 'valid' END
    WHEN 6 THEN 'error' WHEN 7 THEN 'error' WHEN 9 THEN 'error' ELSE 'default' END AS status
FROM (SELECT event_id, {_KIND} AS kind FROM events)""",
    "lab7_enrich": "SELECT doc_id, CASE WHEN lang <> 'en' THEN value END AS value, "
    f"CASE WHEN lang <> 'en' THEN error END AS error FROM (SELECT doc_id, lang, {_MEASURED} FROM documents)",
    "lab8_purpose": f"""
SELECT doc_id, CASE WHEN length(p) % 11 = 0 THEN 'Unable to generate description'
  ELSE '3 messages of ' || (length(p) + length('1 messages of ' || length(p)) + length({_SECOND})) END
  AS high_level_purpose
FROM (SELECT doc_id, {_PURPOSE_PROMPT} AS p FROM (SELECT doc_id, text AS code FROM documents))""",
    "lab9_assemble_labels": _from_functions(
        "function_id, 'about ' || function_name AS purpose, control_flow, "
        "CASE WHEN effects = '' THEN 'none' ELSE effects END AS effects"
    ),
    "lab10_pending": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "lab11_enrich_incremental": f"SELECT doc_id, {_MEASURED} FROM documents",
    "lab12_limit_rows": _from_functions("function_id, function_name") + " ORDER BY file_path, fn_no LIMIT 25",
    "lab13_source_breakdown": "SELECT coalesce(nullif(source, 'src0'), 'unknown') AS source, count(*) AS n "
    "FROM documents GROUP BY 1",
    "emb1_embed": f"SELECT doc_id, length(text)::DOUBLE AS v0, ({_occurrences(chr(39) + 'a' + chr(39))})::DOUBLE AS v1, "
    f"({_occurrences('chr(10)')})::DOUBLE AS v2, ({_occurrences(chr(39) + ' ' + chr(39))})::DOUBLE AS v3 FROM documents",
    "emb2_hash_embed": f"""
WITH t AS (
  SELECT doc_id, ('0x' || substr(md5(tok), 1, 8))::BIGINT % 64 AS bucket
  FROM (SELECT doc_id, unnest({_WORDS}) AS tok FROM documents)),
c AS (SELECT doc_id, bucket, count(*) AS n FROM t GROUP BY doc_id, bucket),
s AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(b AS INTEGER) AS bucket,
  round(CAST(CAST(coalesce(n / norm, 0.0) AS FLOAT) AS DOUBLE), 4) AS value
FROM documents d CROSS JOIN range(0, 64) AS r(b)
LEFT JOIN c ON c.doc_id = d.doc_id AND c.bucket = b LEFT JOIN s ON s.doc_id = d.doc_id""",
    "emb3_truncation_flag": f"SELECT doc_id, len(w) + 2 > 128 AS truncated, "
    f"md5(array_to_string(w[1:126], ' ')) AS head_digest FROM (SELECT doc_id, {_WORDS} AS w FROM documents)",
    "emb3_truncated_count": f"SELECT count(*) FILTER (WHERE len({_WORDS}) + 2 > 512) AS n_truncated, "
    "count(*) AS n_rows FROM documents",
    "emb4_pending_embeddings": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)",
    "emb4_write_back": "SELECT d.doc_id, CAST(1 AS BIGINT) AS n_vectors, "
    "round(coalesce(e.embedding[1]::DOUBLE, d.n_chars % 1000), 4) AS first_entry, "
    "(SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) AS n_first, CAST(0 AS BIGINT) AS n_second "
    "FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id",
    "emb5_missing_counts": "SELECT CAST(0 AS BIGINT) AS doc_id, "
    "count(*) FILTER (WHERE l.quality IS NULL) AS quality, "
    "count(*) FILTER (WHERE e.embedding IS NULL) AS embedding FROM documents d "
    "LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN embeddings e ON d.doc_id = e.vec_id",
    "emb6_embedding_preview": "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, "
    + ", ".join(f"round(embedding[{i + 1}]::DOUBLE, 5) AS p{i}" for i in range(3))
    + " FROM embeddings",
    "fus1_feature_vector": _from_functions(
        "function_id, concat_ws(' ', " + ", ".join(_FEATURES) + ") AS features"
    ),
    "fus2_fit_scaler": _scaler_rows(),
    "fus3_apply_scaler": "SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM lineitem)) / "
        f"(SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END FROM lineitem), 4) AS z{i}"
        for i, c in enumerate(_LINE_COLUMNS.values())
    )
    + " FROM lineitem",
    "fus4_fuse": f"WITH {FUSED} SELECT vec_id, CAST(len(x) AS INTEGER) AS dim, "
    + ", ".join(f"round(x[{i + 1}], 4) AS f{i}" for i in (0, 63, 64, 67, 71))
    + " FROM fused",
    "cls1_binarize_labels": f"WITH {VECTORS} SELECT vec_id, "
    + ", ".join(f"CAST(list_contains(labels, '{c}') AS INTEGER) AS is_{c}" for c in _CLASSES)
    + " FROM v",
    "cls2_label_distribution": f"WITH {VECTORS}, u AS (SELECT unnest(labels) AS label FROM v) "
    "SELECT label, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM v), 4) AS pct FROM u GROUP BY label",
    "cls3_split": "SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey || '#42'), o_orderkey) "
    "<= floor(0.8 * (SELECT count(*) FROM orders)) AS is_train FROM orders",
    "cls4_fit_one_vs_rest": f"WITH {VECTORS} SELECT DISTINCT unnest(labels) AS class, 64 AS dim, true AS is_optimal FROM v",
    "cls7_ablation": f"""
WITH {FUSED}, labelled AS (
  SELECT f.vec_id, CASE WHEN l % 2 <> 0 AND l % 3 <> 0 AND l % 5 <> 0 THEN ['none'] ELSE
    list_concat(list_concat(CASE WHEN l % 2 = 0 THEN ['hardware'] ELSE [] END,
      CASE WHEN l % 3 = 0 THEN ['io'] ELSE [] END), CASE WHEN l % 5 = 0 THEN ['memory'] ELSE [] END) END AS labels,
    row_number() OVER (ORDER BY md5(f.vec_id || '#42'), f.vec_id) > floor(0.8 * (SELECT count(*) FROM fused)) AS is_test
  FROM (SELECT f.vec_id, coalesce(e.label, f.vec_id % 10) AS l FROM fused f LEFT JOIN embeddings e ON e.vec_id = f.vec_id) f),
support AS (
  SELECT class, count(*) FILTER (list_contains(labels, class)) AS support
  FROM labelled, (VALUES {_CLASS_ROWS}) AS c(class) WHERE is_test GROUP BY class)
SELECT variant, class, support::BIGINT AS support, true AS in_range, true AS averages_fit FROM (
  SELECT * FROM support UNION ALL
  SELECT a, sum(support) FROM support, (VALUES ('micro avg'), ('macro avg'), ('weighted avg'), ('samples avg')) AS n(a) GROUP BY a
), (VALUES ('counts (8-dim)'), ('vector (64-dim)'), ('fused (72-dim)')) AS v(variant)""",
    "cls5_predict_labels": f"WITH {PREDICTED} SELECT vec_id, array_to_string(predicted, ',') AS predicted FROM predicted",
    "cls6_classification_report": f"WITH {REPORT} SELECT class, round(precision, 4) AS precision, "
    "round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM report",
    "cls8_worst_class": f"WITH {REPORT} SELECT class, round(f1, 4) AS f1 FROM per_class ORDER BY f1, class LIMIT 1",
    "cls9_examples_for_label": f"WITH {VECTORS} SELECT vec_id, array_to_string(labels, ',') AS labels FROM v "
    "WHERE list_contains(labels, 'memory') ORDER BY vec_id LIMIT 5",
    "ret1_cosine": f"WITH {VECTORS} SELECT a.vec_id, round(list_cosine_similarity(a.e, b.e), 5) AS cosine "
    "FROM v a JOIN v b ON b.vec_id = a.vec_id + 1",
    "ret2_top_k_neighbours": f"WITH {HITS} SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbour_id, "
    "round(similarity, 5) AS similarity FROM hits",
    "ret2_top_k_pruned": f"WITH {HITS} SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbour_id, "
    "round(similarity, 5) AS similarity FROM hits",
    "ret2_pruned_customers": """
WITH v AS (
  SELECT c_custkey, list_transform([c_nationkey + 1, c_acctbal / 1000, c_custkey % 7 + 1, 5],
    lambda x: CAST(CAST(x AS FLOAT) AS DOUBLE)) AS e FROM customer),
n AS MATERIALIZED (SELECT *, list_inner_product(e, e) AS nn FROM v),
sims AS (
  SELECT a.c_custkey AS query_id, b.c_custkey AS neighbour_id,
    round(list_inner_product(a.e, b.e) / sqrt(a.nn * b.nn), 9) AS similarity
  FROM n a, n b WHERE a.c_custkey <> b.c_custkey),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, neighbour_id) AS rank FROM sims)
SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbour_id, round(similarity, 5) AS similarity, true AS under_half
FROM ranked WHERE rank <= 3""",
    "ret3_relevant": f"WITH {VECTORS} SELECT a.vec_id, len(list_intersect(a.labels, b.labels)) > 0 AS rel "
    "FROM v a JOIN v b ON b.vec_id = a.vec_id + 1",
    "ret4_mrr_at_k": f"WITH {HITS} SELECT query_id, round(mrr, 4) AS mrr FROM per_query",
    "ret5_relevant_count": f"WITH {HITS} SELECT query_id, n_relevant FROM relevant",
    "ret6_recall_at_k": f"WITH {HITS} SELECT query_id, round(r3, 4) AS recall FROM per_query",
    "ret7_retrieval_report": f"WITH {HITS} SELECT 'MRR@5' AS metric, round(avg(mrr), 4) AS value FROM per_query "
    "UNION ALL SELECT 'Recall@3', round(avg(r3), 4) FROM per_query "
    "UNION ALL SELECT 'Recall@5', round(avg(r5), 4) FROM per_query",
    "ret8_chance_level": f"WITH {HITS} SELECT round(avg(n_relevant / ((SELECT count(*) FROM v) - 1)), 4) AS chance FROM relevant",
    "ret9_worst_query": f"WITH {HITS}, w AS (SELECT query_id, mrr FROM per_query ORDER BY mrr, query_id LIMIT 1) "
    "SELECT w.query_id, round(mrr, 4) AS mrr, CAST(rank AS INTEGER) AS rank, neighbour_id, "
    "array_to_string(query_labels, ',') AS query_labels, array_to_string(neighbour_labels, ',') AS neighbour_labels "
    "FROM w JOIN hits h ON h.query_id = w.query_id",
    "ret10_inspect_query": f"WITH {HITS}, w AS (SELECT min(vec_id) AS query_id, count(*) AS n_such_rows FROM v "
    "WHERE labels = ['none']) SELECT w.query_id, n_such_rows, CAST(rank AS INTEGER) AS rank, neighbour_id, rel, "
    "array_to_string(neighbour_labels, ',') AS neighbour_labels FROM w JOIN hits h ON h.query_id = w.query_id",
    "clu1_fit_kmeans": "SELECT i::INTEGER AS cluster, max(len(embedding))::INTEGER AS dim, true AS is_mean "
    "FROM embeddings, range(3) AS r(i) GROUP BY i",
    "clu2_assign_clusters": f"WITH {PROFILE} SELECT vec_id, cluster FROM clustered",
    "clu3_dominant_label": f"WITH {PROFILE} SELECT vec_id, dominant FROM clustered",
    "clu4_cluster_profile": f"WITH {PROFILE} SELECT cluster, size, dominant_label, purity, distribution FROM profile",
    "clu5_overall_purity": f"WITH {PROFILE} SELECT round(sum(top) / sum(size), 4) AS purity, "
    "round((SELECT max(c) FROM (SELECT count(*) AS c FROM clustered GROUP BY dominant)) / sum(size), 4) "
    "AS majority_share FROM profile",
    "clu6_misfits": f"WITH {PROFILE}, m AS (SELECT vec_id, c.cluster, dominant AS true_label, "
    "dominant_label AS cluster_label FROM clustered c JOIN profile p ON c.cluster = p.cluster "
    "WHERE dominant <> dominant_label) SELECT *, (SELECT count(*) FROM m) AS n_misfits FROM m ORDER BY vec_id LIMIT 10",
    "clu7_drill_down": _from_functions(
        "function_id, CASE WHEN effects = '' THEN 'none' ELSE effects END AS side_effects, "
        "CAST(call_count AS INTEGER) AS call_count, "
        "CASE WHEN effects = '' AND call_count > 0 THEN 'llm_fallback' ELSE 'deterministic' END AS side_effects_source"
    )
    + " WHERE function_id = 'd7.c#1'",
    "clu8_project_2d": f"""
WITH {FUSED}, labelled AS (
  SELECT CASE WHEN l % 2 <> 0 AND l % 3 <> 0 AND l % 5 <> 0 THEN ['none'] ELSE
    list_concat(list_concat(CASE WHEN l % 2 = 0 THEN ['hardware'] ELSE [] END,
      CASE WHEN l % 3 = 0 THEN ['io'] ELSE [] END), CASE WHEN l % 5 = 0 THEN ['memory'] ELSE [] END) END AS labels
  FROM (SELECT coalesce(e.label, f.vec_id % 10) AS l FROM fused f LEFT JOIN embeddings e ON e.vec_id = f.vec_id))
SELECT view, label, count(*) AS n, true AS is_ordered
FROM (SELECT unnest(labels) AS label FROM labelled), (VALUES ('vector'), ('fused')) AS v(view) GROUP BY view, label""",
    "clu8_neighbour_layout": "SELECT axis, (SELECT count(*) FROM embeddings) AS n, true AS is_unit, true AS is_eigenvector, "
    "true AS is_orthogonal FROM (VALUES ('x'), ('y')) AS a(axis)",
    "rep1_histogram": " UNION ALL ".join(
        _histogram(n, c)
        for n, c in (
            ("l_quantity", "l_quantity"), ("l_extendedprice", "l_extendedprice"),
            ("l_discount", "l_discount"), ("constant", "(5.0 + 0 * l_tax)"),
        )
    ),
    "rep2_describe": " UNION ALL ".join(
        _describe(c, c, "lineitem") for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
    "rep2_describe_features": f"WITH {FUNCTIONS} " + " UNION ALL ".join(_describe(f, f, "g") for f in _FEATURES),
    "rep3_evaluation_summary": f"WITH {REPORT}, {HITS.replace(VECTORS + ',', '')} "
    "SELECT 'classification' AS section, class AS name, round(f1, 4) AS value FROM report "
    "WHERE class IN ('macro avg', 'weighted avg', 'micro avg') "
    "UNION ALL SELECT 'retrieval', 'MRR@5', round(avg(mrr), 4) FROM per_query "
    "UNION ALL SELECT 'retrieval', 'Recall@3', round(avg(r3), 4) FROM per_query "
    "UNION ALL SELECT 'retrieval', 'Recall@5', round(avg(r5), 4) FROM per_query",
    "sco1_score_sources": f"WITH {SCORED} SELECT function_id, function_name AS name, "
    f"'turn 3 after ' || length({_PURPOSE_PROMPT}) || ' characters' AS high_level_purpose, "
    "array_to_string(predicted, ',') AS predicted, "
    "CASE WHEN effects = '' AND len(calls) = 0 THEN '' ELSE array_to_string(ruled, ',') END AS ruled, "
    "control_flow, 24 AS embedding_dim, 3 AS preview_dim FROM scored",
    "sco2_score_stream": "SELECT doc_id AS request_id, "
    "CASE WHEN source IN ('src0', 'src1') THEN '' ELSE 'doc_' || doc_id END AS name, "
    "CASE WHEN source IN ('src0', 'src1') THEN 0 ELSE 24 END AS embedding_dim, "
    "CASE source WHEN 'src0' THEN 'code field must not be empty' "
    "WHEN 'src1' THEN 'no function definition found' ELSE 'scored' END AS outcome FROM documents",
    "sco2_score_stream_once": "SELECT doc_id AS request_id, CASE source WHEN 'src0' THEN 'code field must not be empty' "
    "WHEN 'src1' THEN 'no function definition found' ELSE 'scored' END AS outcome, "
    "CAST(1 AS BIGINT) AS n_answers FROM documents",
    "sco3_compare_rule_and_model": f"""
WITH {SCORED},
d AS (
  SELECT array_to_string(list_sort(list_filter(ruled, lambda x: NOT list_contains(predicted, x))), ',') AS only_rule,
    array_to_string(list_sort(list_filter(predicted, lambda x: NOT list_contains(ruled, x))), ',') AS only_model
  FROM scored)
SELECT only_rule, only_model, count(*) AS n, only_rule = '' AND only_model = '' AS agree FROM d GROUP BY ALL""",
}
