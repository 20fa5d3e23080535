"""Headline queries, timed: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlift.session import build_session  # noqa: E402
from workload import all_queries  # noqa: E402

HEADLINE = (
    "keep_newest",
    "keep_first",
    "dup_listing",
    "merge_incoming_first",
    "merge_large",
    "insert_if_absent",
    "unpivot_attachments",
    "fill_rate",
    "reconcile",
    "backfill_fk",
    "backfill_created_by",
    "orphan_repair",
    "lookup_hot_keys",
    "parent_chain",
    "extract_contacts",
    "parse_dates",
    "import_applications",
    "import_certificates",
    "import_detail_children",
    "import_shareholders",
    "import_installations",
    "import_installation_children",
    "import_water",
    "import_water_children",
    "import_fees",
    "import_users",
    "transfer_restore",
    "post_import",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()[0]
    # One small job first, so that the first query does not pay for starting the JVM's workers.
    queries["ordered_listing"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    line = {"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(scale)}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
