"""Summarise the physical plans of registered queries.

    python -m marginlib.plans.explain [sf_dir] [query ...]

For each query: shuffle exchanges (outside broadcasts of seeds), broadcast
exchanges, join strategies, aggregate operators and whether the scan has
pushed filters.  Plans are taken after execution (AQE final plan).
"""

from __future__ import annotations

import re
import sys

from ..session import build_session
from .queries import QUERIES

HEADLINE = ["int_order_items_costed", "fct_sku_profit", "fct_sku_profit_monthly",
            "fct_sku_channel", "fct_sku_cost_watch", "stg_returns", "upsert_orders"]


def summary(df) -> dict:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    out = {"shuffles": 0, "broadcasts": 0, "smj": 0, "bhj": 0, "hash_agg": 0, "sort_agg": 0,
           "window": 0, "pushed_filters": False}
    for ln in lines:
        if re.search(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", ln):
            out["shuffles"] += 1
        if "BroadcastExchange" in ln:
            out["broadcasts"] += 1
        if "SortMergeJoin" in ln:
            out["smj"] += 1
        if "BroadcastHashJoin" in ln:
            out["bhj"] += 1
        if re.search(r"\bHashAggregate\(", ln):
            out["hash_agg"] += 1
        if re.search(r"\bSortAggregate\(", ln):
            out["sort_agg"] += 1
        if re.search(r"\bWindow \[", ln):
            out["window"] += 1
        if "PushedFilters: [" in ln and "PushedFilters: []" not in ln:
            out["pushed_filters"] = True
    return out


def main(argv) -> None:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or HEADLINE
    spark = build_session("local[8]", shuffle_partitions=16)
    cols = ["shuffles", "broadcasts", "bhj", "smj", "hash_agg", "sort_agg", "window", "pushed_filters"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for n in names:
        s = summary(QUERIES[n](spark, sf))
        print(f"| {n} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main(sys.argv)
