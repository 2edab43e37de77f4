"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query finds only the adapted sources in the run's store: what it reads of
the other intermediates it writes itself, as the first query of a run. It is
forced with a no-op write, so the time covers plan construction, every
job, and no driver-side collection. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from instalytics import catalog  # noqa: E402
from instalytics.session import local_session  # noqa: E402

HEADLINE = [
    "fe33_consumer_master",
    "fe21_cust_approved_order_d180",
    "fe10_cust_approved_limit",
    "fe05_instal_events_agg",
    "fe23_instal_ovd_d360",
    "fe17_cust_latefee",
    "fe32_cust_util_d180",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    q = catalog.queries()
    # setup (not in the total): the shared part of the adapters, and a warm JVM;
    # the queries run as they are registered
    t = time.perf_counter()
    q["fe19_cust_order_d180"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    setup = round(time.perf_counter() - t, 3)
    times = {}
    store = catalog.run_store(spark, sf_dir)
    for name in names:
        store.forget(keep=("src-line",))
        t = time.perf_counter()
        q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir,
                      "cpus": int(cpus), "setup_sec": setup}))


if __name__ == "__main__":
    main()
