"""Run registered queries next to their SQL in DuckDB: python -m checks.compare"""

from __future__ import annotations

import argparse
import math
import os
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return con


def _normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return repr(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_normal(r[i]) or "" for i in order) for r in rows
    )


def difference(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None if both engines agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    ours = sorted_rows(df.columns, df.collect())
    result = con.execute(ORACLES[name])
    theirs = sorted_rows([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} / {len(theirs[1])} rows"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"row\n  {a}\n  {b}"
    return None


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf-dir", default="/root/testdata/sf0.001")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf_dir)
    for name in args.names or QUERIES:
        start = time.time()
        try:
            found = difference(spark, con, args.sf_dir, name) or "same"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:24} {time.time() - start:6.1f} s  {found}", flush=True)


if __name__ == "__main__":
    main()
