"""Compare catalogue queries with their SQL counterparts: ``python tests/oracle_check.py DIR [NAME...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as con:
        for name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        result = con.execute(sql)
        return [d[0] for d in result.description], result.fetchall()


def normalised(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=lambda r: tuple(map(str, r)))


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, (float, int)):
        return math.isclose(a, b, rel_tol=0, abs_tol=0)
    return a == b


def differences(spark_df, folder: str, sql: str) -> list[str]:
    """Human-readable differences, empty when equal."""
    columns, expected = oracle_rows(folder, sql)
    if sorted(spark_df.columns) != sorted(columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(columns)}"]
    got = normalised(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want = normalised(columns, expected)
    if len(got) != len(want):
        return [f"{len(got)} rows, expected {len(want)}"]
    return [
        f"{g} != {w}" for g, w in zip(got, want) if not all(same(x, y) for x, y in zip(g, w))
    ]


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from sparkmon.session import get_session

    session = get_session("oracle-check", master="local[8]", conf={"spark.driver.memory": "8g"})
    folder, wanted = sys.argv[1], sys.argv[2:]
    sql = oracle_sql()
    for name, plan in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                diff = differences(plan(session, folder), folder, sql[name])
                status = "ok" if not diff else f"{len(diff)} DIFFERENCES {diff[:2]}"
            else:
                status = f"{plan(session, folder).count()} rows"
        except Exception as e:
            status = f"ERROR {str(e)[:1500]}"
        print(f"{name:24s} {time.time() - start:6.1f}s {status}", flush=True)
