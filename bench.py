"""Runs the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from millrace.plans import catalogue

HEADLINE = ["join_agg_topk", "pricing_summary", "three_way_join", "filter_ops", "prewhere", "top_k_rows", "with_totals", "win_agg_frames", "limit_by", "final_replacing", "not_in_subquery", "scalar_subquery", "quantile", "hourly_timeseries", "funnel", "array_join", "update_rewrite", "date_diff"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    n = re.sub(r"\D", "", cpus) or "8"
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", n)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = catalogue.queries(), {}
    for warm in (True, False):
        for name in HEADLINE:
            began = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if not warm:
                took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, second run", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
