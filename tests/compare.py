"""Run queries and their SQL side by side."""

from __future__ import annotations

import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize() + 0)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v)


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def difference(spark, con, sf_dir, fn, sql):
    """None when the results are equal, else a short text."""
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in names) for r in df.collect())
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    if sorted(cols) != names:
        return f"columns {names} != {sorted(cols)}"
    at = [cols.index(c) for c in names]
    want = sorted(tuple(norm(r[i]) for i in at) for r in cur.fetchall())
    if got == want:
        return None
    only = [x for x in got if x not in set(want)][:2], [x for x in want if x not in set(got)][:2]
    return f"{len(got)} rows != {len(want)} rows; {names}; spark only {only[0]}; sql only {only[1]}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf), e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            diff = difference(spark, con, sf, fn, sqls.get(name))
        except Exception as ex:
            diff = f"{type(ex).__name__}: {str(ex)[:600]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} {time.time() - t:.2f}s {diff or ''}", flush=True)
    print("bad:", bad, "of", len(e.queries()))
