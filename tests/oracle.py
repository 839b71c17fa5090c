"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(value):
    """One comparable form of a value: exact, with a type tag that ignores int width."""
    if value is None:
        return "~"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0!r}"
    if isinstance(value, int):
        return f"{value}"
    return f"{type(value).__name__}:{value}"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir) -> str:
    """Empty text when equal, else what differs."""
    df = query(spark, sf_dir)
    got = df.collect()
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(df.columns, got), canonical(cols, want)
    if a == b:
        return ""
    in_a, in_b = set(a), set(b)
    left = [x for x in a if x not in in_b][:2]
    right = [x for x in b if x not in in_a][:2]
    return f"{sorted(cols)}\n   got  {left}\n   want {right}"[:1500]


def main() -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from ledgerwing.session import build_session

    sf_dir = sys.argv[1]
    only = set(sys.argv[2:])
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    oracles = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, query, oracles[name], sf_dir)
            else:
                n = len(query(spark, sf_dir).collect())
                problem = "" if n else "no rows"
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - t:.2f}s {problem}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
