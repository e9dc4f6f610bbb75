"""The end-to-end job -- landed tables in, staging/intermediate/mart
tables out.

The SQL project keeps staging and intermediate models as views, so every
mart re-derives the costed lines.  Here the costed lines are computed once
(one shuffle-free stage over the orders) and written, partitioned by order
month; the marts read that table.  The cost watch only needs the last
``window_days`` of orders and reads only the matching month partitions.

Outputs (Parquet, one folder each): int_order_items_costed,
fct_order_item_profit, fct_sku_profit, fct_sku_profit_monthly,
fct_sku_channel, fct_sku_cost_watch, stg_returns, dq_checks.

    python -m marginlib.plans.pipeline --sf-dir /root/testdata/sf0.01 --out <dir>
"""

from __future__ import annotations

import argparse
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, costing, marts, returns, staging
from ..session import build_session, job_dir, write_atomic
from ..sources import seeds, testdata
from ..sources.store import Store
from . import inputs

MONTH = "order_month"


def run(spark: SparkSession, raw_orders: DataFrame, raw_catalog: DataFrame,
        raw_returns: DataFrame, out_dir: str | Store, as_of: str, window_days: int = 90,
        excluded_status_codes: Iterable[int] = (), aliases: DataFrame | None = None,
        channel_map: DataFrame | None = None, fee_rules: DataFrame | None = None) -> dict:
    """Build all outputs; returns the folder (or the store's table) of each.

    In a folder each table is replaced as it is done; in a `Store` all of them are
    published at the end, as one version.
    """
    store = out_dir if isinstance(out_dir, Store) else None
    base = store.manifest()["version"] if store else None
    staged, written = {}, {}

    def write(name: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        if store:
            staged[name] = store.stage(name, df, partition_by or ())
            written[name] = f"{store.path}/data/{name}"
        else:
            written[name] = write_atomic(spark, df, f"{out_dir.rstrip('/')}/{name}", partition_by=partition_by)

    def read(name: str) -> DataFrame:
        return store.read_staged(name, staged[name]) if store else spark.read.parquet(written[name])

    channel_map = channel_map if channel_map is not None else seeds.channel_map(spark)
    fee_rules = fee_rules if fee_rules is not None else seeds.fee_rules(spark)
    aliases = aliases if aliases is not None else seeds.sku_aliases(spark)
    costed = costing.costed_lines(raw_orders, channel_map, fee_rules, excluded_status_codes)
    # Rebalanced by month before the write: small months get one file, a large
    # one is split to the advisory size, so files grow with data, not tasks.
    costed = costed.withColumn(MONTH, F.trunc("order_date", "month")).hint("rebalance", MONTH)
    write("int_order_items_costed", costed, [MONTH])
    lines = read("int_order_items_costed")

    catalog = staging.stg_catalog(raw_catalog)
    since_month = F.trunc(F.date_sub(F.lit(as_of).cast("date"), window_days), "month")
    tables = {
        "fct_order_item_profit": marts.fct_order_item_profit(lines),
        "fct_sku_profit": marts.fct_sku_profit(lines, catalog),
        "fct_sku_profit_monthly": marts.fct_sku_profit_monthly(lines),
        "fct_sku_channel": marts.fct_sku_channel(lines),
        # month partitions before the window are pruned; the exact
        # ordered_at bound is applied inside the mart
        "fct_sku_cost_watch": marts.fct_sku_cost_watch(
            lines.where(F.col(MONTH) >= since_month), catalog, as_of, window_days),
        "stg_returns": returns.stg_returns(raw_returns, catalog, aliases),
    }
    for name, df in tables.items():
        write(name, df)

    r = {n: read(n) for n in written}
    dq = checks.run_checks([
        ("not_null", "stg_orders", staging.stg_orders(raw_orders), "order_id"),
        ("unique", "stg_orders", staging.stg_orders(raw_orders), "order_id"),
        ("not_null", "stg_order_items", r["int_order_items_costed"], "order_item_id"),
        ("unique", "stg_order_items", r["int_order_items_costed"], "order_item_id"),
        ("not_null", "stg_returns", r["stg_returns"], "return_line_id"),
        ("unique", "stg_returns", r["stg_returns"], "return_line_id"),
        ("not_null", "stg_returns", r["stg_returns"], "sku"),
        ("not_null", "fct_sku_profit", r["fct_sku_profit"], "sku"),
        ("unique", "fct_sku_profit", r["fct_sku_profit"], "sku"),
        ("not_null", "fct_sku_cost_watch", r["fct_sku_cost_watch"], "sku"),
        ("unique", "fct_sku_cost_watch", r["fct_sku_cost_watch"], "sku"),
    ]).unionByName(staging.malformed_line_numbers(raw_orders))
    write("dq_checks", dq)
    if store:
        store.commit(staged, base=base)
    return written


def run_for_testdata(spark: SparkSession, sf_dir: str, out_dir: str | None = None) -> dict:
    out_dir = out_dir or job_dir(spark, "marginlib", "pipeline", sf_dir.strip("/").replace("/", "_"))
    return run(spark, inputs.raw_orders(spark, sf_dir), inputs.raw_catalog(spark, sf_dir),
               inputs.raw_returns(spark, sf_dir), out_dir, testdata.AS_OF,
               aliases=testdata.test_aliases(spark, sf_dir))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", default=None)
    ap.add_argument("--master", default=None)
    ap.add_argument("--cluster", action="store_true", help="use the cluster-scale settings")
    a = ap.parse_args(argv)
    spark = build_session(a.master, cluster=a.cluster)
    for name, path in run_for_testdata(spark, a.sf_dir, a.out).items():
        print(name, path)


if __name__ == "__main__":
    main()
