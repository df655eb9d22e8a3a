"""Benchmark: build the five input tables once, store them, time every query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is run to completion with a ``noop`` write (full plan, every
column, nothing collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.plans import catalog  # noqa: E402
from ledgerloom.plans.session import get_spark, shared_folder  # noqa: E402
from ledgerloom.sources import derive  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_spark(f"local[{cpus}]", app="ledgerloom-bench", conf={
        "spark.sql.shuffle.partitions": str(2 * cpus),
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="ledgerloom-bench-"),
    })
    # stored inputs live beside the checkpoints, in the session's shared folder
    store = f"{shared_folder(spark).rstrip('/')}/bench-inputs-{uuid.uuid4().hex}"

    times: dict[str, float] = {}
    t0 = time.perf_counter()
    tables = derive.load_driver_tables(spark, sf_dir, store=store)
    build = round(time.perf_counter() - t0, 3)
    for name, op in catalog.OPS.items():
        t = time.perf_counter()
        op(tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds_all_queries", "value": total, "unit": "sec",
                      "queries": times, "input_build_sec": build, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
