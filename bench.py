"""Time the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is fully materialised with the ``noop`` sink (every row and
column computed, nothing collected), after one warm-up run of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablesync.plans import registry  # noqa: E402
from tablesync.session import job_session  # noqa: E402

HEADLINE = [
    "jdbc_scan",
    "jdbc_scan_partitioned",
    "decimal_to_float",
    "string_cleanup",
    "upsert",
    "delete_by_keys",
    "upsert_type_move",
    "full_refresh",
    "watermark_max",
    "incremental_filter",
    "flatten_envelope",
    "rename_by_map",
    "deep_to_utc",
    "empty_struct_to_null",
    "route_counts",
    "route_names",
    "clean_text",
    "paged_scan",
    "repartition_rows",
    "copy_schema",
    "document_sync",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = job_session(
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(max(8, cpus * 2)),
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up of the session, not of any query: one JVM scan and one Python
    # worker start (Arrow UDFs and the Python data source share the workers).
    registry.QUERIES["jdbc_scan"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    registry._field_map(spark, sf_dir)
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
