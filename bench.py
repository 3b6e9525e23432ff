"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [--all]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adledger.plans.catalog import all_queries  # noqa: E402
from adledger.session import get_session  # noqa: E402

HEADLINE = [
    "tier_summary_of_listings", "parse_listing", "clean_listing_text", "visible_text", "union_links",
    "latest_by_key", "first_by_key_capped", "materialize", "materialize_listings", "backfill_text",
    "record_to_source", "write_if_absent", "read_jsonl", "price_tier", "stratified_split", "day_split",
    "regression_metrics", "classification_report", "confusion_matrix", "trend_halves", "rank_stability",
    "text_vocab", "text_sequence", "standard_scale", "gbt_regressor", "permutation_importance",
    "llm_extract", "stream_latest", "read_run_texts", "grid_search", "text_classifier", "structured_classifier",
    "fused_classifier", "stream_extract",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    names = list(registered) if "--all" in sys.argv else HEADLINE
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start workers
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28} {seconds[name]:7.2f}s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").split("/")[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
