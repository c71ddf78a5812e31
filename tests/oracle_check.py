"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

    python tests/oracle_check.py [sf_dir] [query ...]

Compares row count, column names (sorted) and the multiset of rows (columns
sorted by name, rows sorted).  Prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    """Exact values (both sides already round to 6 decimals themselves); only
    -0.0 is folded into 0.0 and NaN made comparable."""
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
          "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def type_mismatches(sdf, rel) -> list[str]:
    s = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in sdf.schema.fields}
    d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return [f"{c}: spark {s[c]} vs duck {d[c]}" for c in s if c in d and s[c] != d[c]]


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return f"{name:28s} rows={len(srows):7d} spark={t1 - t0:6.2f}s  (no oracle)"
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    t2 = time.time()
    ok_cols = sorted(scols) == sorted(dcols)
    ok_n = len(srows) == len(drows)
    ok_vals = ok_cols and ok_n and _rows(scols, srows) == _rows(dcols, drows)
    status = "OK " if ok_vals else "BAD"
    msg = f"{status} {name:28s} rows={len(srows):7d}/{len(drows):7d} spark={t1 - t0:6.2f}s duck={t2 - t1:5.2f}s"
    tm = type_mismatches(sdf, rel)
    if tm:
        msg += f" TYPES {tm}"
    if not ok_cols:
        msg += f" cols spark={sorted(scols)} duck={sorted(dcols)}"
    elif not ok_vals and ok_n:
        a, b = _rows(scols, srows), _rows(dcols, drows)
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        msg += f" first diffs={diffs}"
    return msg


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    import __spark_entry__ as entry
    from questa.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    for name in (names or list(qs)):
        try:
            print(compare(spark, con, name, qs[name], sqls.get(name), sf_dir), flush=True)
        except Exception as e:  # report and go on
            print(f"ERR {name:28s} {type(e).__name__}: {str(e)[:400]}", flush=True)


if __name__ == "__main__":
    main()
