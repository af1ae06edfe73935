"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from sheetloom.plans.catalogue import QUERIES  # noqa: E402
from sheetloom.session import clean_up  # noqa: E402

HEADLINE = ["catalogue_report", "dq_all", "match_all", "all_facts", "extract_price_facts", "reconcile_prices",
            "enrich_variants", "dominant_colour", "upload_collisions", "merge_canonical", "export_import26",
            "scan_catalogue_cells"]


def session(cpus: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("sheetloom-bench")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sheetloom-bench-"))
             .config("sheetloom.spread", cpus)  # the given tables are one file each
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took = round(time.perf_counter() - start, 3)
        clean_up(spark)
        return took

    small = str(Path(sf_dir).parent / "sf0.001")
    if Path(small).exists():  # one warm-up, so that no query pays for starting the engine
        run(names[0], small)
    seconds = {name: run(name, sf_dir) for name in names}
    print(json.dumps({"metric": "total wall time of headline queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}))


if __name__ == "__main__":
    main()
