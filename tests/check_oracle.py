"""Run every registered query against its SQL in DuckDB: ``python tests/check_oracle.py [sf] [name ...]``."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    try:
        f = float(v)
    except (TypeError, ValueError):
        return str(v)
    return str(v) if isinstance(v, str) else (None if math.isnan(f) else f)


def key(row):
    return tuple((x is None, str(type(x)), round(x, 4) if isinstance(x, float) else x) for x in row)


def compare(df, con, sql):
    """None when equal, else a description."""
    cols = sorted(df.columns)
    t0 = time.time()
    mine = sorted(([norm(x) for x in r] for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=key)
    t1 = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} vs {sorted(names)}"
    order = [names.index(c) for c in cols]
    if os.environ.get("TIMES"):
        print(f"   spark {t1 - t0:.1f}s duckdb {time.time() - t1:.1f}s")
    theirs = sorted(([norm(r[i]) for i in order] for r in cur.fetchall()), key=key)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}; {mine[:2]} vs {theirs[:2]}"
    near = 0
    for a, b in zip(mine, theirs):
        if a != b:
            if all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 2e-6) for x, y in zip(a, b)):
                near += 1
                continue
            return f"values {dict(zip(cols, a))} vs {dict(zip(cols, b))}"
    return f"{near} rows differ in the last digit" if near else None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    d = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(d), entry.oracle_sql(), 0
    queries = entry.queries()
    for name, fn in queries.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, d)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                problem = None if df.count() > 0 else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        took = time.time() - t
        bad += problem is not None
        if problem or took > 8 or names:
            print(f"{'FAIL' if problem else 'slow' if took > 8 else 'ok'} {name} {took:.1f}s {problem or ''}", flush=True)
    print(f"{len(queries)} queries, {len(oracles)} with SQL, {bad} failed")


if __name__ == "__main__":
    main()
