"""Headline-query benchmark.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs a fixed set of registered queries end to end (each result is fully
computed by writing it to the ``noop`` sink, so nothing is collected to the
driver) and prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Landed API responses are written once per run to a Parquet landing folder
under the checkpoint folder (untimed), as an ingest job would find them; the
flatteners are timed on that read path.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "b6_flatten_ranked_keywords",
    "d10_top_keywords",
    "b1_flatten_serp",
    "b3_flatten_backlinks",
    "c1_attempt_records",
    "c2_first_success",
    "c5_failed_targets",
    "d7_client_data",
    "d8_client_data_by_domain",
    "e14_match_datasets",
    "f3_client_counts",
    "f9_add_domains",
    "h6_backfill_ids_by_hour",
    "h9_domain_inventory",
    "h10_domain_inventory_union",
    "h15_drift",
    "b16_dedupe",
    "i1_call_cost",
    "i5_session_totals",
    "i6_compaction_points_both",
    "g1_clean_domain_data",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("searchlake-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g")
             .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from searchlake.session import ensure_checkpoint_dir, scratch_path
    ensure_checkpoint_dir(spark)   # the session's shared folder; a scratch one only when unset

    from searchlake.plans import registry
    from searchlake.sources import responses as R
    from searchlake.sources import testviews as V

    # untimed: land the API responses once, like an ingest job would find them
    for maker in (V.ranked_responses, R.serp_responses, R.backlinks_responses):
        V.land(spark, sf_dir, maker, scratch_path(spark, "landing-" + maker.endpoint))

    registry.load_all()
    times = {}
    for name in HEADLINE:
        fn = registry.QUERIES[name]
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
