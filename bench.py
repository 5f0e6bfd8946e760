"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query is built and fully executed; its result goes to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from onefold.workload import QUERIES

HEADLINE = [
    "j1_text_enrichment",
    "j2_page_records",
    "j4_ratings_extract",
    "j6_bulk_clean",
    "c1_ratings_join",
    "c4_components",
    "c7_similar_titles",
    "d12_last_write_wins",
    "d13_keep_first",
    "e2_dense_ids",
    "j8_cluster",
    "j9_reconcile",
    "j10_build_gold",
    "j12_idempotent_rebuild",
    "j17_constraint_checks",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("onefold-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="onefold-bench-"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, where: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("j9_reconcile", folder)  # warm-up of the virtual machine, not counted
    seconds = {name: run(name, folder) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
