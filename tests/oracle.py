"""Run a registered query and its SQL twin side by side and compare the results."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return round(value, 9)
    if hasattr(value, "as_tuple"):
        return f"decimal {value}"
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty if none."""
    found = df.collect()
    cursor = con.execute(sql)
    wanted_columns = [d[0] for d in cursor.description]
    wanted = cursor.fetchall()
    if sorted(df.columns) != sorted(wanted_columns):
        return [f"columns {sorted(df.columns)} / {sorted(wanted_columns)}"]
    left, right = rows_of(df.columns, found), rows_of(wanted_columns, wanted)
    if len(left) != len(right):
        only = [r for r in left if r not in set(right)][:2] + [("sql",)] + [r for r in right if r not in set(left)][:2]
        return [f"rows {len(left)} / {len(right)}: {only}"]
    wrong = [(a, b) for a, b in zip(left, right) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if wrong:
        return [f"{len(wrong)} of {len(left)} rows differ, e.g. {wrong[0]}"]
    return [] if left else ["no rows"]


def main() -> None:
    import __spark_entry__ as entry
    from parchline.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle = entry.oracle_sql()
    names = sys.argv[1:] or list(entry.queries())
    bad = 0
    for name in names:
        began = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            if name in oracle:
                found = compare(df, con, oracle[name])
                note = "ok" if not found else f"WRONG {found[0][:900]}"
            else:
                note = f"rows {df.count()}"
        except Exception as problem:
            found, note = [1], f"ERROR {type(problem).__name__}: {str(problem)[:1500]}"
        bad += note[:2] not in ("ok", "ro")
        print(f"{name:28s} {time.time() - began:6.1f}s {note}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
