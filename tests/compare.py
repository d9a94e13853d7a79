"""Run registered queries beside their SQL twins and compare the rows.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return 0.0 if value == 0 else value
    if value is not None and type(value).__name__ == "Decimal":
        return float(value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def differences(spark_df, con, sql) -> list[str]:
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    done = con.execute(sql)
    want = canonical([c[0] for c in done.description], done.fetchall())
    problems = []
    if got[0] != want[0]:
        problems.append(f"columns {got[0]} != {want[0]}")
    elif len(got[1]) != len(want[1]):
        problems.append(f"rows {len(got[1])} != {len(want[1])}")
    else:
        kinds = [
            (c, type(a).__name__, type(b).__name__)
            for c, a, b in zip(got[0], got[1][0] if got[1] else (), want[1][0] if want[1] else ())
            if a is not None and b is not None and type(a) is not type(b)
        ]
        if kinds:
            problems.append(f"types {kinds}")
        off = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
        if off:
            problems.append(f"{len(off)} rows differ, e.g. {off[0]}")
    return problems


def main() -> None:
    from pyspark.sql import SparkSession

    from modelyard.plans.catalog import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        entry, start = QUERIES[name], time.time()
        try:
            df = entry.run(spark, sf_dir)
            if entry.sql is None:
                verdict = [] if df.count() else ["no rows"]
            else:
                verdict = differences(df, con, entry.sql)
        except Exception as problem:
            verdict = [f"{type(problem).__name__}: {str(problem)[:700]}"]
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += bool(verdict)
        print(f"{'ok  ' if not verdict else 'FAIL'} {time.time() - start:6.2f}s {name} {'; '.join(verdict)}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
