"""Compare registered queries with their SQL oracles: python tools/check.py [sf] [name or family ...]"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session():
    return (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
            .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
            .config("spark.sql.session.timeZone", "UTC").getOrCreate())


def database(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def norm(v):
        if v is None or (isinstance(v, float) and v != v):
            return "<null>"
        if isinstance(v, bool):
            return str(int(v))
        if isinstance(v, float):
            return repr(v + 0.0)
        if isinstance(v, int):
            return repr(v)
        return str(v)

    return sorted(columns), sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got), None
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return len(got), f"columns {got_cols} != {want_cols}"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return len(got), f"rows {len(got)} vs {len(want)}\n   spark only {only_got}\n   sql only   {only_want}"
    return len(got), None


def main():
    from sparkkit import queries as Q

    args = sys.argv[1:]
    sf = args.pop(0) if args else "0.01"
    folder = f"/root/testdata/sf{sf}"
    import importlib

    if args and all(a in Q.FAMILIES for a in args):
        for a in args:
            importlib.import_module(f"sparkkit.queries.{a}")
        names = [n for n, q in Q.REGISTRY.items() if q.run.__module__.rsplit(".", 1)[-1] in args]
    else:
        Q.load()
        names = args or list(Q.REGISTRY)
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    bad = 0
    for n in names:
        q = Q.REGISTRY[n]
        start = time.time()
        try:
            count, problem = compare(q.run(spark, folder), con, q.sql)
        except Exception:
            count, problem = -1, traceback.format_exc()[-1500:]
        took = time.time() - start
        mark = "FAIL" if problem else ("EMPTY" if count == 0 else ("ok" if q.sql else "ok(rows)"))
        bad += bool(problem)
        print(f"{mark:9}{q.operator:10}{n:34}{count:8} rows {took:6.2f}s" + (f"\n   {problem}" if problem else ""), flush=True)
    print(f"{len(names)} queries, {bad} failures")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
