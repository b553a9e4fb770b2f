"""Run a registered query and its SQL twin and compare names, rows and values exactly."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if hasattr(value, "asDict"):
        return {k: _plain(v) for k, v in sorted(value.asDict().items())}
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in sorted(value.items())}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(r[i]) for i in order]) for r in rows)


def compare(query, sql, spark, con, sf_dir):
    """(ok, detail, spark seconds, row count)"""
    start = time.time()
    frame = query(spark, sf_dir)
    got = frame.collect()
    took = time.time() - start
    if sql is None:
        return True, "rows only", took, len(got)
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    want = relation.fetchall()
    if sorted(names) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(names)}", took, len(got)
    a, b = rows_of(frame.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return False, f"{len(a)} rows != {len(b)}", took, len(got)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} differ, e.g. {bad[0][0][:600]}\n   <> {bad[0][1][:600]}", took, len(got)
    return True, "", took, len(got)


if __name__ == "__main__":
    import __spark_entry__ as entry
    from wattlake.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    session = build_session()
    session.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = []
    for name in sorted(queries):
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            ok, detail, took, n = compare(queries[name], oracle.get(name), session, con, folder)
        except Exception as error:  # report and go on
            ok, detail, took, n = False, f"{type(error).__name__}: {str(error)[:700]}", 0.0, 0
        print(f"{'ok  ' if ok else 'FAIL'} {name:44s} {took:6.2f}s {n:7d} {detail}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
