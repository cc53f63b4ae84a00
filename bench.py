"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from skyledger.registry import QUERIES
from skyledger.session import configure

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
STREAMS = ("stream_temp_gap", "stream_partials_merge", "stream_clean")


def main() -> None:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("skyledger-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .config("spark.log.level", "ERROR")
    )
    spark = configure(builder).getOrCreate()
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    QUERIES["temp_gap"](spark, SF_DIR).collect()  # start the executor and the code generator
    seconds = {}
    for name, run in QUERIES.items():
        start = time.perf_counter()
        run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "all queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
                "rows": lines,
                "stream_rows_per_sec": {s: round(lines / seconds[s]) for s in STREAMS},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
