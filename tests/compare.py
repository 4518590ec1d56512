"""Run registered queries beside their SQL and compare the answers."""

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
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return ("n",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        return ("f", "nan") if math.isnan(v) else ("f", v)
    if isinstance(v, int):
        return ("i", v)
    return ("s", str(v))


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(df, con, sql: str) -> str | None:
    """What differs between a DataFrame and a SQL answer, or None."""
    got_cols, got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = _sorted([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; e.g. {next((g for g, w in zip(got, want) if g != w), None)} vs {next((w for g, w in zip(got, want) if g != w), None)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{got_cols}\n  got  {g}\n  want {w}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as registry
    from barloom.session import local_session

    spark, con = local_session(), connect(sf_dir)
    queries, oracle = registry.queries(), registry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracle:
                df = queries[name](spark, sf_dir)
                diff = difference(df, con, oracle[name])
            else:
                diff = None if queries[name](spark, sf_dir).count() >= 0 else "no rows"
        except Exception as exc:  # report and go on with the next query
            diff = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {time.time() - start:6.2f}s {name} {diff or ''}", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
