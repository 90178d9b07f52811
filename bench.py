"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then REPEATS times; the best time counts. Results go to
Spark's ``noop`` sink, so that every row and column is worked out and nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from maskwright.plans import QUERIES
from maskwright.plans.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

HEADLINES = [
    "mask_documents",
    "detect_documents_all",
    "detect_documents",
    "dataset_audit_cube",
    "row_audit",
    "flag_split",
    "mask_text",
    "mask_entities",
    "restore",
    "restore_with_mapping",
    "audit_log",
    "leak_check",
    "private_enrich_column",
    "write_masked",
    "stream_mask",
]


def run(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    # The tables are files of one split, so the tasks are asked for.
    spark = local_session(CPUS, spark__maskwright__inputPartitions=CPUS)
    run(spark, HEADLINES[0])
    times = {n: round(min(run(spark, n) for _ in range(REPEATS)), 3) for n in HEADLINES}
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "mask_ms_per_document": round(1000 * times["mask_documents"] / documents, 4),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
