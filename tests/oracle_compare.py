"""Run registered queries on Spark and their oracle SQL on DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]

The comparison is order-insensitive: columns sorted by name, rows sorted,
values normalised (decimals to strings with their scale, floats rounded to
9 digits, dates to ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "\0NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


_SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT", "float": "FLOAT",
}


def spark_type_as_duck(simple: str) -> str:
    if simple.startswith("decimal"):
        return simple.upper()
    return _SPARK_TO_DUCK.get(simple, simple.upper())


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort()
    return out


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, str]:
    from martforge.plans.registry import oracle_sql, queries
    qs, os_ = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_types = {f.name: spark_type_as_duck(f.dataType.simpleString()) for f in df.schema.fields}
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        t1 = time.time()
        if name not in os_:
            results[name] = f"rows-only ({len(s_rows)} rows)"
            if verbose:
                print(f"{name:32s} {results[name]}  spark {t1 - t0:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(os_[name])
            d_cols = [c[0] for c in cur.description]
            d_types = {c[0]: str(c[1]) for c in cur.description}
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"ORACLE ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        status = []
        if sorted(s_cols) != sorted(d_cols):
            status.append(f"columns differ spark={s_cols} duck={d_cols}")
        type_diff = {c: (s_types[c], d_types.get(c)) for c in s_cols
                     if c in d_types and s_types[c] != d_types[c]}
        if type_diff:
            status.append(f"types differ {type_diff}")
        if len(s_rows) != len(d_rows):
            status.append(f"rows differ spark={len(s_rows)} duck={len(d_rows)}")
        if not status:
            a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                status.append(f"values differ, e.g. {diff}")
        results[name] = "OK" if not status else "; ".join(status)
        if verbose:
            print(f"{name:32s} {results[name][:600]}  ({len(s_rows)} rows, spark {t1 - t0:.1f}s)",
                  flush=True)
    return results


def main():
    from martforge.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf_dir, names)
    bad = {k: v for k, v in res.items() if v != "OK" and not v.startswith("rows-only")}
    print(f"\n{len(res) - len(bad)}/{len(res)} OK")
    for k, v in bad.items():
        print("FAIL", k, v[:300])


if __name__ == "__main__":
    main()
