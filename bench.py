"""Times the headline queries and prints one JSON line.

Every result is written to the ``noop`` sink, so all rows are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from storelens.queries import REGISTRY  # noqa: E402
from storelens.session import build_session  # noqa: E402

HEADLINE = [
    "mart_sales", "mart_sales_turnover", "mart_operations", "mart_marketing",
    "mart_support_batch", "mart_support_stream", "job_quality", "job_quality_profile",
    "job_bronze_to_silver", "sql_adhoc", "vld_required_fields", "win_prev_interaction",
    "cln_dedupe_rows", "src_object_manifest", "st_marketing_kpis", "st_support_kpis",
    "st_validate", "st_item_store", "st_file_ingest",
]
REPEATS = 3


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8,
                          spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        timed(spark, name, sf_dir)
    queries = {name: round(min(timed(spark, name, sf_dir) for _ in range(REPEATS)), 3)
               for name in names}
    spark.stop()
    print(json.dumps({"metric": "total_headline_seconds",
                      "value": round(sum(queries.values()), 3), "unit": "sec",
                      "queries": queries, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
