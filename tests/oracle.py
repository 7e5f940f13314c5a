"""Compare registered queries with their SQL in DuckDB; also usable from the shell.

    python tests/oracle.py SF [name-part ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("earlybell-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    cols = sorted(names)
    order = [names.index(c) for c in cols]
    return cols, sorted((tuple(norm(r[i]) for i in order) for r in cur.fetchall()), key=repr)


def type_issues(df, con, sql):
    """Types a value hash could read differently on the two sides."""
    issues = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t.startswith(("decimal", "array", "struct", "map")):
            issues.append(f"spark {f.name}:{t}")
    for name, t, *_ in con.execute("DESCRIBE " + sql).fetchall():
        if t.startswith(("DECIMAL", "HUGEINT", "STRUCT", "MAP")) or t.endswith("[]"):
            issues.append(f"duck {name}:{t}")
    return issues


def main() -> None:
    from workload.catalog import QUERIES, run

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    parts = sys.argv[2:]
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, q in QUERIES.items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        t0 = time.time()
        try:
            df = run(name, spark, sf_dir)
            cols, got = rows_of_spark(df)
            t1 = time.time()
            if q.sql is None:
                print(f"----  {name}: {len(got)} rows, no sql, {t1 - t0:.1f}s")
                continue
            wcols, want = rows_of_duck(con, q.sql)
            notes = type_issues(df, con, q.sql)
            ok = cols == wcols and got == want and not notes
            bad += not ok
            print(f"{'ok  ' if ok else 'FAIL'}  {name}: {len(got)}/{len(want)} rows, {t1 - t0:.1f}s duck {time.time() - t1:.1f}s {notes or ''}", flush=True)
            if not ok:
                if cols != wcols:
                    print("   cols", cols, wcols)
                else:
                    a, b = set(got), set(want)
                    print("   ", cols)
                    print("   spark only", sorted(a - b, key=repr)[:3])
                    print("   duck only ", sorted(b - a, key=repr)[:3])
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name}: {type(exc).__name__} {str(exc)[:600]}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
