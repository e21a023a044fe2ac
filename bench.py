"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one line of JSON."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path
from statistics import median

HERE = Path(__file__).resolve().parent
HEADLINE = ("call_cg_taps", "call_ch_taps", "mbias_cycles", "per_spot_summary", "saturation_summary", "extract_reject_counts", "barcode_nearest")


def main() -> None:
    sys.path.insert(0, str(HERE))
    os.environ["PYTHONPATH"] = f"{HERE}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"
    from pyspark.sql import SparkSession

    from methylspark import catalog

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(3):  # the first warms up
            begin = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(median(times[1:]), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
