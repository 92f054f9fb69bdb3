"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if hasattr(value, "as_tuple"):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(df, con, sql):
    """(same, message)"""
    mine = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = sorted_rows([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return False, f"columns {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return False, f"{len(mine[1])} / {len(theirs[1])} rows"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return False, f"{a} / {b}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return False, f"types {[type(x).__name__ for x in a]} / {[type(x).__name__ for x in b]}"
    return True, f"{len(mine[1])} rows"


if __name__ == "__main__":
    import __spark_entry__ as e
    from stridelake.session import build_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(e.queries())
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = []
    for name in names:
        start = time.time()
        try:
            df = e.queries()[name](spark, folder)
            same, note = compare(df, con, e.oracle_sql()[name]) if name in e.oracle_sql() else (True, f"{df.count()} rows, no SQL")
        except Exception as error:
            same, note = False, f"{type(error).__name__}: {str(error)[:900]}"
        print(("ok  " if same else "FAIL"), name, f"{time.time() - start:.1f}s", note, flush=True)
        failed += [] if same else [name]
    print("failed:", failed)
