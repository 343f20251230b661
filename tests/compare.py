"""Run queries and their SQL side by side: ``python tests/compare.py [folder] [name ...]``."""

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def difference(df, con, sql):
    """None when equal as bags of rows with equal column names and kinds, else a short text."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in rel.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    if len(want) != len(got):
        extra = [r for r in got if r not in set(want)][:2], [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows != {len(want)}; {extra}"[:900]
    if not want:
        return "empty"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"[:900]
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp"}
    types = {r[0]: kinds.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    mine = dict(df.dtypes)
    wrong = {c: (mine[c], types[c]) for c in order if mine[c] != types[c]}
    return f"types {wrong}" if wrong else None


def main():
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, every = connect(folder), oracle_sql(), queries()
    failed = 0
    for name in sys.argv[2:] or every:
        start = time.time()
        try:
            df = every[name](spark, folder)
            result = difference(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as e:
            result = f"ERROR {type(e).__name__} {str(e)[:700]}"
        failed += bool(result) and not result.startswith("no SQL")
        print(f"{name:26s} {time.time() - start:6.1f}s  {result or 'ok'}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
