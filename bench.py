"""Time the registered queries and print one JSON line.

BENCH_SF_DIR   folder of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local worker threads (default 8)
BENCH_QUERIES  comma-separated names (default, and "all": every query of the library)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from driftline.queries import REGISTRY
from driftline.session import build_session

def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if chosen in ("", "all") else chosen.split(",")
    input_bytes = sum(p.stat().st_size for p in Path(folder).glob("*.parquet"))
    extra = {"spark.master": f"local[{cpus}]", "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    spark = build_session("bench", input_bytes, cpus, **extra)
    spark.sparkContext.setLogLevel("ERROR")
    # Start the executor threads and code generation once, outside the timings.
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    timings: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {timings[name]}", file=sys.stderr)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
