"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from duebook.plans import invoice  # noqa: E402
from duebook.session import build_session  # noqa: E402
from workload import QUERIES  # noqa: E402
from workload.frames import Frames  # noqa: E402

HEADLINE = """
    customer_aging aging_as_of ledger_items billing_lines prorate material_enrich resolve_sold_to
    resolve_customer_key due_date profit_center_fence resolve_business_code tariff_percentage
    join_as_of join_lateral_top1 join_fanout win_largest_line agg_doc_totals agg_duplicates dq_all
    invoice_fact sku_fact snapshot_slice daily_run
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("duebook-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    began = time.perf_counter()
    # the source tables of the composed queries, stored once as they are where the library runs
    Frames(spark, folder).tables([*invoice.TABLES, "security_tags", "mart"])
    load = time.perf_counter() - began
    seconds = {}
    for key in HEADLINE:
        began = time.perf_counter()
        QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "load": round(load, 3),
                      "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
