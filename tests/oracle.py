"""Runs registered queries against their SQL: ``python tests/oracle.py [sf] [name-prefix ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, int):
        return value
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(cells, key=repr)


def compare(spark, con, name: str, build, sql: str | None, sf_dir: str) -> tuple[str, str]:
    df = build(spark, sf_dir)
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return ("rows", f"{len(got)} rows")
    cur = con.execute(sql)
    want_names, want = _rows([c[0] for c in cur.description], cur.fetchall())
    if got_names != want_names:
        return ("FAIL", f"columns {got_names} against {want_names}")
    if len(got) != len(want):
        return ("FAIL", f"{len(got)} rows against {len(want)}: {got[:2]} / {want[:2]}")
    bad = [(a, b) for a, b in zip(got, want) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if bad:
        return ("FAIL", f"{len(bad)} of {len(got)} differ on {got_names}\n   {bad[0][0]}\n   {bad[0][1]}")
    return ("ok", f"{len(got)} rows")


def main() -> int:
    from rimsight.plans import catalog
    from rimsight.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    picks = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session()
    con = connect(sf_dir)
    failed = 0
    for name, build in catalog.QUERIES.items():
        if picks and not any(name.startswith(p) for p in picks):
            continue
        start = time.time()
        try:
            status, note = compare(spark, con, name, build, catalog.ORACLE.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            status, note = "ERROR", str(error)[:600]
        failed += status in ("FAIL", "ERROR")
        if status != "ok" or "0 rows" == note:
            print(f"{status:6} {name:40} {time.time() - start:6.1f}s {note}", flush=True)
        else:
            print(f"{status:6} {name:40} {time.time() - start:6.1f}s {note}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
