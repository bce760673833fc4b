"""Wall-clock of every query, run to the end twice without collecting its rows: cold, then warm."""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lakeops-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS if CPUS.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lakeops-bench-"))
        .getOrCreate()
    )
    # Views that have to fail once are part of some queries; their errors are outcomes, not news.
    spark.sparkContext.setLogLevel("OFF")
    # JVM and scan start-up is not any query's cost.
    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    seconds, warm = {}, {}
    for name, query in QUERIES.items():
        for taken in (seconds, warm):
            start = time.perf_counter()
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            taken[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    scale = re.search(r"sf([\d.]+)$", SF_DIR.rstrip("/"))
    sf = float(scale[1]) if scale else None
    result = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}
    print(json.dumps({**result, "warm": warm, "warm_total": round(sum(warm.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
