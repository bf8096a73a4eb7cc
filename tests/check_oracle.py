"""Run queries and their SQL twins side by side: python tests/check_oracle.py SF_DIR [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from __spark_entry__ import oracle_sql, queries  # noqa: E402


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, name):
    """(rows, difference or None)"""
    df = queries()[name](spark, sf_dir)
    mine = canon(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        return len(mine[1]), None
    cursor = con.execute(sql)
    theirs = canon([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return len(mine[1]), f"columns {mine[0]} / {theirs[0]}"
    if [repr(r) for r in mine[1]] != [repr(r) for r in theirs[1]]:
        left, right = set(map(repr, mine[1])), set(map(repr, theirs[1]))
        return len(mine[1]), f"rows {len(mine[1])}/{len(theirs[1])}; only here {sorted(left - right)[:3]}; only there {sorted(right - left)[:3]}"
    return len(mine[1]), None


if __name__ == "__main__":
    sf, names = sys.argv[1], sys.argv[2:] or list(queries())
    spark, con = session(), connect(sys.argv[1])
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for n in names:
        start = time.time()
        try:
            rows, difference = compare(spark, con, sf, n)
        except Exception as error:
            rows, difference = -1, "".join(traceback.format_exception_only(error))[:1500]
        bad += difference is not None
        kind = "sql" if n in oracle_sql() else "rows"
        print(f"{'FAIL' if difference else 'ok'}\t{n}\t{kind}\t{rows}\t{time.time() - start:.2f}s\t{difference or ''}", flush=True)
    print("failures:", bad)
