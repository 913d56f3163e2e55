"""Compare every registered query with its SQL: ``python tests/compare.py <folder> [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else (None if math.isnan(value) else value)
    return value


def table(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def sql_rows(con, sql: str):
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def differences(left, right) -> str | None:
    (lc, lr), (rc, rr) = left, right
    if sorted(lc) != sorted(rc):
        return f"columns {sorted(lc)} != {sorted(rc)}"
    a, b = table(lc, lr), table(rc, rr)
    if len(a) != len(b):
        only = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
        return f"rows {len(a)} != {len(b)} {str(only)[:600]}"
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{str(x)[:300]} != {str(y)[:300]}"
    return None


def main() -> int:
    import importlib

    entry = importlib.import_module("__spark_entry__")
    from wordtide.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare",
        f"local[{os.cpu_count()}]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
         "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        started = time.time()
        try:
            got = spark_rows(queries[name](spark, folder))
            seconds = time.time() - started
            problem = differences(got, sql_rows(con, oracle[name])) if name in oracle else None
            status = f"FAIL {problem}" if problem else ("ok" if name in oracle else "rows only")
            print(f"{name:30s} {seconds:6.2f}s {len(got[1]):8d} rows  {status}", flush=True)
            failed += bool(problem)
        except Exception as e:  # noqa: BLE001
            failed += 1
            print(f"{name:30s} ERROR {type(e).__name__} {str(e)[:700]}", flush=True)
            if names:
                traceback.print_exc()
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
