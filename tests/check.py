"""Compare every query with its SQL: columns, row count, values in any order."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both agree, else what differs first."""
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} / {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{str(a)[:700]}\n   / {str(b)[:700]}"
    return None


def main(sf_dir: str, *names: str) -> int:
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark, con, bad = make_session(), connect(sf_dir), 0
    sqls = entry.oracle_sql()
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            wrong = difference(run(spark, sf_dir), con, sqls[name]) if name in sqls else "no SQL"
        except Exception as problem:  # noqa: BLE001 - a report, not a handler
            wrong = f"{type(problem).__name__}: {str(problem)[:900]}"
        bad += wrong is not None
        print(f"{'OK ' if wrong is None else 'BAD'} {name} {time.time() - start:.2f}s", wrong or "", flush=True)
    print("differing:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(*sys.argv[1:]))
