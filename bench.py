"""Time the headline queries: one JSON line, seconds per query (better of two runs, all rows computed)."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks import CASES

HEADLINE = [
    "a5_snapshot_manifest", "a7_row_file_names", "b1_select_rows", "c2_coerce", "d2_row_checksum", "d3_classify_changes",
    "d8_allocate_ids", "e1_upsert", "e2_seed_fill", "e9_diff_rows", "e11_apply_by_guid", "e13_dedupe_incoming",
    "e14_apply_snapshot", "e1_upsert_repeated_keys", "e11_apply_content_pages", "e14_apply_snapshot_table", "f1_extract_links",
    "f2_rewrite_links", "f3_link_sweep", "f6_rewrite_links_in_fields", "f7_clear_orphan_refs", "f9_value_census",
    "g1_fk_orphans", "g2_delete_cascade", "g3_dependency_levels", "h1_build_paths", "h4_assemble_rows", "h6_renumber", "i3_canonical_xml",
    "i4_xml_fill", "j2_missing_assets", "j7_reconcile", "k2_import_permissions",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_WORK_DIR", "/tmp/checkpoints"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            CASES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    result = {
        "metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
