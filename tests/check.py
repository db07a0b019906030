"""Run registered queries in Spark and their SQL in DuckDB; report differences.

Usage: python -m tests.check [name-regex] [sf-folder]
"""

from __future__ import annotations

import math
import re
import sys
import time

import duckdb

from tableloom.session import TABLES


def cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return ("f", v)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, (list, tuple)):
        return tuple(cell(x) for x in v)
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(data, key=repr)


def close(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple) and len(a) == len(b) == 2 and a[0] == b[0] == "f":
        return math.isclose(a[1], b[1], rel_tol=1e-9, abs_tol=1e-9)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(close(x, y) for x, y in zip(a, b))
    return a == b


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark_df, con, sql):
    """None when equal, otherwise a short text on what differs."""
    sc, sr = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    dc, dr = normal([d[0] for d in cur.description], cur.fetchall())
    if sc != dc:
        return f"columns {sc} != {dc}"
    if sr == dr:
        return None
    in_sql, in_spark = set(dr), set(sr)
    a, b = [r for r in sr if r not in in_sql], [r for r in dr if r not in in_spark]
    if len(sr) != len(dr):
        return f"rows {len(sr)} != {len(dr)}; spark {a[:2]} sql {b[:2]}"
    kind = "nearly" if len(a) == len(b) and all(close(x, y) for x, y in zip(a, b)) else "differs"
    return f"{kind}: {len(a)} rows; spark {a[:2]} sql {b[:2]}"


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    pattern = sys.argv[1] if len(sys.argv) > 1 else "."
    folder = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, oracle, bad = duck(folder), entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if not re.search(pattern, name):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in oracle:
                said = compare(df, con, oracle[name])
                n = "" if said is None else said
            else:
                n, said = f"rows only: {df.count()}", None
        except Exception as e:  # noqa: BLE001 - report and go on
            said = n = f"{type(e).__name__}: {str(e)[:600]}"
        if said:
            bad.append(name)
        print(f"{'BAD' if said else 'ok '} {name} {time.time() - start:.2f}s {n}", flush=True)
    print(f"{len(bad)} bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
