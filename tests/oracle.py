"""Compares queries with their SQL in DuckDB: python tests/oracle.py FOLDER [NAME...]"""

import datetime
import decimal
import math
import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return int(v) if v == int(v) else round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), Counter(tuple(plain(r[k]) for k in order) for r in rows)


def difference(spark, con, folder, query, sql):
    df = query(spark, folder)
    a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    b = rows_of([c[0] for c in cur.description], cur.fetchall())
    if a[0] != b[0]:
        return f"columns {a[0]} and {b[0]}"
    x, y = a[1] - b[1], b[1] - a[1]
    return f"{sum(x.values())} rows only here: {list(x)[:2]}, {sum(y.values())} only in SQL: {list(y)[:2]}" if x or y else ("no rows" if not a[1] else "")


if __name__ == "__main__":
    import time

    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    s = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sys.argv[1]), e.oracle_sql()
    for name, q in e.queries().items():
        if name in sqls and (not sys.argv[2:] or any(name.startswith(x) for x in sys.argv[2:])):
            t = time.time()
            try:
                bad = difference(s, con, sys.argv[1], q, sqls[name])
            except Exception as x:  # noqa: BLE001
                bad = f"{type(x).__name__}: {str(x)[:400]}"
            if bad:
                print("BAD", name, bad, flush=True)
    print("compared")
