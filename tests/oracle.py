"""Compare registered queries with their SQL on DuckDB: ``python tests/oracle.py [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return repr(v)
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, queries, sql) -> str | None:
    """None when equal, else what differs."""
    df = queries[name](spark, folder)
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in sql:
        return None if got else "no rows"
    result = con.execute(sql[name])
    names = [d[0] for d in result.description]
    types = dict(zip(names, [str(d[1]) for d in result.description]))
    want_columns, want = _rows(names, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for c, t in df.dtypes:
        if t in kinds and types[c] != kinds[t]:
            return f"type of {c}: {t} != {types[c]}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; extra {list(set(got) - set(want))[:3]} missing {list(set(want) - set(got))[:3]}"
    if got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b]
        return f"{len(bad)} rows differ, e.g. {bad[:3]}"
    return None


def main(argv: list[str]) -> int:
    from tests.session import make_session

    from gridloom.registry import QUERIES, SQL

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con, failed = make_session(), connect(folder), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, QUERIES, SQL)
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += problem is not None
        kind = "sql" if name in SQL else "rows"
        print(f"{name:32s} {kind:5s} {time.time() - start:6.2f}s {'ok' if problem is None else 'FAIL ' + problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} ok")
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
