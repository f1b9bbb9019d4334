"""Compare a query with its SQL, as sorted rows under the same column names."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, con, sf_dir: str, run, sql: str) -> str:
    result = run(spark, sf_dir)
    got = rows_of(result.columns, [tuple(r) for r in result.collect()])
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    want = rows_of(names, answer.fetchall())
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    if got == want:
        return ""
    first = next(((g, w) for g, w in zip(got, want) if g != w), None)
    return f"{len(got)} rows against {len(want)}; first difference {first}"
