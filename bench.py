"""Times the whole job and every registered query; prints one JSON line.

The value is the time of the job from the raw tables to the last report. After it each query is
timed on its own: those naming a table or view of the bank include building and writing it, the
reports read tables that are there by then.

BENCH_SF_DIR  folder of the star tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from ledgerloom.plans import registry
from ledgerloom.plans.job import run_job
from ledgerloom.plans.star import raw_bank_tables
from ledgerloom.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="256k",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the engine before the clock runs.
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_custkey").count().write.format("noop").mode("overwrite").save()

    start = time.perf_counter()
    built = run_job(raw_bank_tables(spark, sf_dir), tempfile.mkdtemp(prefix="bench-"))
    job = round(time.perf_counter() - start, 3)
    postings = built["raw_trans"].count()

    timings: dict[str, float] = {}
    for name, query in registry.QUERIES.items():
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "bank job, raw tables to all reports",
                "value": job,
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "raw_transactions": postings,
                "transactions_per_sec": round(postings / job),
                "all_queries_sec": round(sum(timings.values()), 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
