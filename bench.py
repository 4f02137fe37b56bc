"""Time the headline queries and print one JSON line.

Every query is computed in full and its rows are thrown away (noop sink), so
neither files nor the driver bound the time, unless writing is the query.  Two
queries that are not timed run first, to start the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillstar.session import get_session  # noqa: E402
from tillstar.verify import queries as registered  # noqa: E402

HEADLINE = [
    "dedupe_by_key",
    "unique_flag",
    "surrogate_key",
    "key_lookup",
    "key_lookup_shuffled",
    "wide_customers",
    "wide_products",
    "wide_orders",
    "wide_order_items",
    "wide_payments",
    "wide_shipments",
    "wide_returns",
    "quality_orders",
    "quality_order_items",
    "quality_payments",
    "dim_customer",
    "dim_product",
    "fact_orders",
    "fact_order_items",
    "fact_payments",
    "fact_shipments",
    "fact_returns",
    "fact_inventory",
    "whole_run",
]


WARM_UP = ["quality_suppliers", "dim_supplier"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR")
            or tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    queries = registered.queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in WARM_UP:
        run(name)
    seconds = {name: run(name) for name in only}
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
