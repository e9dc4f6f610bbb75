"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the no-op sink (full execution, no
collect), twice: ``queries`` holds the second (warm) run, ``cold`` the
first, which at this size is mostly JIT warm-up and code generation.
Landing and the whole job run once.  ``value`` is the sum of ``queries``.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import uuid  # noqa: E402

from marginlib.plans import inputs, pipeline  # noqa: E402
from marginlib.session import job_dir  # noqa: E402
from marginlib.plans.queries import QUERIES  # noqa: E402
from marginlib.session import build_session  # noqa: E402

HEADLINE = [
    "int_order_items_costed",
    "fct_order_item_profit",
    "fct_sku_profit",
    "fct_sku_profit_monthly",
    "fct_sku_channel",
    "fct_sku_cost_watch",
    "stg_returns",
    "upsert_orders",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="marginlib-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    times = {}
    # Landing (payload fixtures -> typed landed rows), timed on its own; the
    # queries below read the landed tables, as the models read landed data.
    for name, build in [("land_raw_orders", inputs.build_raw_orders),
                        ("land_raw_catalog", inputs.build_raw_catalog),
                        ("land_raw_returns", inputs.build_raw_returns)]:
        t = time.perf_counter()
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    for read in (inputs.raw_orders, inputs.raw_catalog, inputs.raw_returns):
        read(spark, sf_dir).count()
    cold = {}
    for n in names:
        for run in (cold, times):
            t = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            run[n] = round(time.perf_counter() - t, 3)
    if not sys.argv[1:]:
        # The whole job: costed lines written once, six tables + checks from it.
        t = time.perf_counter()
        pipeline.run_for_testdata(spark, sf_dir, job_dir(spark, "marginlib", "bench", uuid.uuid4().hex))
        times["pipeline_all_tables"] = round(time.perf_counter() - t, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "cold": cold,
                      "cold_total": round(sum(cold.values()), 3), "sf": sf}))


if __name__ == "__main__":
    main()
