"""Compare registered queries with their SQL form in DuckDB: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(columns, rows):
    """Columns by name, rows in a fixed order, values with their type."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def _value(v):
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    return v


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return canonical([d[0] for d in cur.description], cur.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for g, w in zip(got[1], want[1]):
        if repr(g) != repr(w):
            return f"{g} != {w}"
    return None


def main():
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con, sql = session(), connect(sf_dir), oracle_sql()
    bad = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = spark_rows(run(spark, sf_dir))
            took = time.time() - start
            problem = difference(got, sql_rows(con, sql[name])) if name in sql else None
            state = "rows " if name not in sql else ("ok   " if problem is None else "DIFF ")
            if not got[1]:
                state = "EMPTY"
        except Exception as e:  # noqa: BLE001
            took, problem, state, got = time.time() - start, str(e)[:1500], "ERROR", (0, [])
        bad += state.strip() in ("DIFF", "ERROR", "EMPTY")
        print(f"{state} {name:45s} {len(got[1]):7d} rows {took:6.2f}s {problem or ''}", flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main()
