"""Run catalog queries beside their SQL in DuckDB: ``python -m tests.compare [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
import warnings

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

# How each engine names the same type.
SAME_TYPE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(r[i]) for i in order) for r in rows))


def difference(df, con, sql: str) -> str | None:
    """None when rows, names and types agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    wanted = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for f in df.schema.fields:
        want = SAME_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
        if kinds[f.name] != want:
            return f"type of {f.name}: {want} != {kinds[f.name]}"
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want_rows = canonical(names, wanted)
    if len(got) != len(want_rows):
        return f"{len(got)} rows != {len(want_rows)}; only ours {[r for r in got if r not in set(want_rows)][:2]}, only sql {[r for r in want_rows if r not in set(got)][:2]}"
    for a, b in zip(got, want_rows):
        if a != b:
            return f"values {a} != {b}"
    return None if got else "no rows"


def main(argv: list[str]) -> int:
    from orderflow.catalog import ORACLES, QUERIES
    from orderflow.session import local_session

    warnings.filterwarnings("ignore")
    sf_dir = f"/root/testdata/sf{argv[0] if argv else '0.001'}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    failed = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = difference(df, con, ORACLES[name]) if name in ORACLES else f"no sql; {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
