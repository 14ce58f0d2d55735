"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and prints
one JSON line. Each query runs once to warm up and its best of two is taken."""

from __future__ import annotations

import json
import os
import time

from tidemark.plans.queries import QUERIES
from tidemark.session import session

HEADLINE = (
    "asof_resolution", "latest_state", "hourly_state", "json_explode_typed", "quantile_lag", "ordered_string_agg",
    "ledger_anti_nullsafe", "mapping_best_meaning", "mapping_conflicts", "resolution_status_case", "dq_summary",
    "replace_by_message", "combine_batches", "archive_dedupe", "semi_touched_keys", "hourly_touched", "topn_batch_pick",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    }
    spark = session("bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        times = []
        for _ in range(3):
            began = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(min(times[1:]), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
