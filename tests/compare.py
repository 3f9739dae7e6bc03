"""Run registered queries against their SQL in DuckDB:
``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        return x.item() if hasattr(x, "item") else x

    rows = [tuple(plain(x) for x in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def difference(spark_rows, duck_rows) -> str | None:
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows against {len(duck_rows)}"
    wrong = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None


def check(spark, con, sf_dir, name, run, sql) -> tuple[bool, str]:
    start = time.time()
    got = run(spark, sf_dir)
    kinds = dict(got.dtypes)
    got = got.toPandas()
    spent = time.time() - start
    if sql is None:
        return True, f"{len(got)} rows, no SQL ({spent:.1f}s)"
    cursor = con.execute(sql)
    kinds_sql = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.df()
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    problem = difference(canonical(got), canonical(want))
    if problem:
        return False, problem
    return True, f"{len(got)} rows ({spent:.1f}s) {[(c, kinds[c], kinds_sql[c]) for c in kinds if not same_kind(kinds[c], kinds_sql[c])]}"


def same_kind(spark_kind: str, duck_kind: str) -> bool:
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    return pairs.get(spark_kind) == duck_kind


def main() -> int:
    import __spark_entry__ as entry
    from codeloom.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare")
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        try:
            ok, text = check(spark, con, sf_dir, name, queries[name], oracles.get(name))
        except Exception as exc:  # noqa: BLE001 - report and go on
            ok, text = False, f"{type(exc).__name__}: {str(exc)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += not ok
        print("ok  " if ok else "FAIL", name, text, flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
