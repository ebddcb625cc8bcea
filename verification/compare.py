"""Run queries beside their SQL and report what differs.

    python -m verification.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]").appName("hazeline")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def oracle_connection(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(columns, rows):
    """Sorted rows with columns in name order; -0.0 and whole doubles compare as numbers."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = [tuple("" if r[i] is None else f"{type(r[i]).__name__}:{r[i]}" for i in order) for r in rows]
    return [columns[i] for i in order], sorted(key)


def difference(spark_df, con, sql) -> tuple[int, str]:
    mine = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rows = len(mine[1])
    cursor = con.execute(sql)
    theirs = canonical([c[0] for c in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return rows, f"columns {mine[0]} != {theirs[0]}"
    if mine[1] != theirs[1]:
        only = sorted(set(mine[1]) - set(theirs[1]))[:3]
        other = sorted(set(theirs[1]) - set(mine[1]))[:3]
        return rows, f"{len(mine[1])} rows != {len(theirs[1])}; spark {only}; sql {other}"
    return rows, ""


def main() -> int:
    from verification.oracles import ORACLES
    from verification.queries import QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    spark, con, failed = session(), oracle_connection(args.sf), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in args.names or QUERIES:
        start = time.time()
        try:
            rows, found = difference(QUERIES[name](spark, args.sf), con, ORACLES[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            rows, found = 0, f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.2f}s {rows} rows {found}", flush=True)
    print(f"{failed} of {len(args.names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
