"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", "/tmp/checkpoints")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v else "0"
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, case):
    """(spark rows, message); the message is empty when both sides agree."""
    df = case.run(spark, folder)
    got_names, got = rows_of(df.columns, df.collect())
    n = sum(got.values())
    plan = df._jdf.queryExecution().executedPlan().toString()
    slow = [p for p in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython") if p in plan]
    if slow:
        return n, f"plan uses {slow}"
    if not case.sql:
        return n, ""
    cur = con.execute(case.sql)
    want_names, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got_names != want_names:
        return n, f"columns {got_names} != {want_names}"
    if got != want:
        extra, lack = got - want, want - got
        return n, f"{n} rows, SQL {sum(want.values())}; only Spark {list(extra.items())[:2]}; only SQL {list(lack.items())[:2]}"
    return n, "" if n else "no rows"


def main(folder, names):
    from checks import CASES

    spark, con = session(), duck(folder)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, c in CASES.items():
        if names and not any(name.startswith(x) for x in names):
            continue
        t = time.time()
        try:
            n, message = compare(spark, con, folder, c)
        except Exception as e:  # report and go on with the next query
            n, message = -1, f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(message)
        print(f"{'FAIL' if message else 'ok  '} {name:32s} {n:8d} rows {time.time() - t:6.1f}s {message}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    main(sys.argv[1], sys.argv[2:])
