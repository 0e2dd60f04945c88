"""Time the headline queries; prints one JSON line.

Every query runs once to warm the JVM at the smallest scale and is then timed once, its
result written to Spark's ``noop`` sink, so all rows and columns are computed.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from tillbridge.plans.queries import QUERIES

HEADLINE = (
    "mart_daily_sales",
    "cls_classified",
    "cls_reason_counts",
    "fact_full",
    "fact_convert_large",
    "fx_asof",
    "fx_daily_dim",
    "mart_region_sales",
    "mart_currency_summary",
    "mart_data_quality",
    "rec_full_chain",
    "set_except_both",
    "sink_anti_join",
    "src_row_identity",
    "src_manifest_stats",
    "fn_parse_numeric",
    "fn_round_half_even",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    times = {}
    for name in HEADLINE:
        if os.path.isdir(small):
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
