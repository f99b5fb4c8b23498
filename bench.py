"""Benchmark the headline queries.

Runs each query on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS]: one warm-up pass over all queries, then the median of
$BENCH_REPEAT timed runs each.  A run executes the whole plan into Spark's
``noop`` sink (nothing collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventide.plans import QUERIES  # noqa: E402
from eventide.session import get_spark  # noqa: E402

HEADLINE = [
    "hot_items", "item_view_counts", "item_view_counts_direct", "hot_pages",
    "marketing_by_channel_profile", "marketing_total_profile", "ads_by_province",
    "page_views_hourly", "page_views_salted",
    "unique_visitors_hourly", "unique_visitors_bitmap", "unique_visitors_hll", "running_unique_visitors",
    "ad_clicks_capped", "ad_blacklist",
    "login_fail_pairs", "login_fail_bursts", "login_fail_runs",
    "order_paid", "order_timeouts", "order_payment_status",
    "pay_receipt_match", "unmatched_pays", "unmatched_receipts", "late_page_events",
]


def run(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    # local[N]: shuffle partitions = cores already; AQE coalescing would only cut parallelism here
    # (on a cluster keep it on and size spark.sql.shuffle.partitions to the data).
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus,
                      extra={"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    for n in names:
        run(spark, n, sf_dir)
    times = {n: round(statistics.median(run(spark, n, sf_dir) for _ in range(repeat)), 3) for n in names}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "repeat": repeat}))


if __name__ == "__main__":
    main()
