"""Time every registered query and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names; default all), BENCH_QUERY_SEC (a query
is stopped after so long; default 300), BENCH_LIMIT_SEC (no query begins later; default 600;
what did not run or was stopped is listed), BENCH_SHARED_DIR (folder for
intermediate tables; default a temporary one, since the master is local).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import threading
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from modelyard.plans.catalog import QUERIES  # noqa: E402
from modelyard.session import release  # noqa: E402


HEADLINE = "baseline_workflow"


def run(df: DataFrame) -> None:
    """Evaluate every row and column without bringing them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    query_sec, limit_sec = (float(os.environ.get(f"BENCH_{k}_SEC", v)) for k, v in (("QUERY", 300), ("LIMIT", 600)))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("modelyard-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="modelyard-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.read.parquet(f"{sf_dir}/nation.parquet"))  # start-up is not part of any query
    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}

    def clock(name: str) -> float:
        start = time.perf_counter()
        watch = threading.Timer(query_sec, spark.sparkContext.cancelAllJobs)
        watch.start()
        try:
            run(QUERIES[name].run(spark, sf_dir))
        finally:
            watch.cancel()
        return round(time.perf_counter() - start, 3)

    began, not_run = time.perf_counter(), []
    for name in sorted(names, key=lambda n: n.startswith("forest_")):  # the fits of 500 trees come last
        if time.perf_counter() - began > limit_sec:
            not_run.append(name)
            continue
        try:
            seconds[name] = clock(name)
        except Exception as problem:  # keep the other timings
            failed[name] = f"{type(problem).__name__}: {str(problem)[:200]}"
        finally:
            spark.catalog.clearCache()
    warm = [clock(HEADLINE) for _ in range(3)] if HEADLINE in seconds else []
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    result = {
        "metric": "total_wall_clock",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "lineitem_rows": lines,
    }
    if warm:
        result["headline"] = {
            "query": HEADLINE, "cold_sec": seconds[HEADLINE], "warm_sec": warm,
            "rows_per_sec": round(lines / min(warm)),
        }
    if failed:
        result["failed"] = failed
    if not_run:
        result["not_run"] = not_run
    print(json.dumps(result))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
