"""Run registered queries beside their SQL and report differences.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got_cols = df.columns
    got = rows_of(got_cols, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want_cols = [d[0] for d in res.description]
    want = rows_of(want_cols, res.fetchall())
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    if got == want:
        return None
    ours, theirs = set(got), set(want)
    extra, lack = sorted(ours - theirs, key=repr)[:2], sorted(theirs - ours, key=repr)[:2]
    return f"rows {len(got)} vs {len(want)}; only ours {extra}; only sql {lack}"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), e.oracle_sql(), 0
    for name, query in e.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            diff = compare(spark, con, query, sqls[name], sf_dir) if name in sqls else "no SQL"
        except Exception as ex:
            diff = f"{type(ex).__name__}: {str(ex)[:600]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} {time.time() - start:.2f}s {diff or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
