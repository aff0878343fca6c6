"""Compare registered queries with their SQL: python tests/check_oracles.py [sf_dir] [names...]."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else v)
        df[c] = df[c].map(lambda v: v if v is None else repr(float(v)) if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def compare(spark, con, name, sf_dir):
    queries, sql = entry.queries(), entry.oracle_sql()
    start = time.time()
    got = queries[name](spark, sf_dir).toPandas()
    took = time.time() - start
    if name not in sql:
        return f"{name}: rows only, {len(got)} rows {took:.1f}s", True
    want = con.execute(sql[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"{name}: COLUMNS {sorted(got.columns)} {sorted(want.columns)}", False
    a, b = normal(got), normal(want)
    if len(a) != len(b):
        return f"{name}: ROWS {len(a)} {len(b)}", False
    bad = [c for c in a.columns if not a[c].equals(b[c])]
    if bad:
        c = bad[0]
        at = [i for i in range(len(a)) if a[c][i] != b[c][i]]
        detail = "\n".join(f"   {x}: {a[x][at[0]]!r:.700} | {b[x][at[0]]!r:.700}" for x in a.columns)
        return f"{name}: VALUES {bad} ({len(at)} rows)\n{detail}", False
    return f"{name}: ok, {len(a)} rows {took:.1f}s", True


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        try:
            print("CHECK", compare(spark, con, name, sf_dir)[0], flush=True)
        except Exception as exc:
            print("CHECK", name, "FAILED", type(exc).__name__, str(exc)[:600], flush=True)
