"""Compare registered queries with their SQL on the test tables. Usage: check_catalog.py [names...]"""

import math
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "as_tuple"):
        return round(float(value), 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def database(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark, con, folder, run, sql):
    """None when equal, else what differs."""
    df = run(spark, folder)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    want = rows_of(names, relation.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    if got != want:
        at = next(i for i, (a, b) in enumerate(zip(got, want)) if a != b)
        return f"row {at}: {got[at]} <> {want[at]}"
    return None if got else "no rows on either side"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tallyloom.session import clear_scratch

    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config(
        "spark.ui.enabled", "false"
    ).config("spark.driver.memory", "12g").config("spark.driver.host", "localhost").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = database(folder), 0
    for name, run in entry.queries().items():
        if sys.argv[1:] and not any(name.startswith(a) for a in sys.argv[1:]):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, run, entry.oracle_sql().get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        clear_scratch(spark)
        print(f"{name:28s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print("bad:", bad)
