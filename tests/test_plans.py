"""Plan shape: the things that decide cost at scale."""
import json

from helpers import item, order, raw_catalog, raw_orders
from marginlib.operators import costing, marts, staging
from marginlib.plans import inputs
from marginlib.sources import seeds, testdata


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_costing_has_no_line_shuffle(spark):
    ro = raw_orders(spark, [order(1, [item(11, "A", 10)])])
    c = costing.costed_lines(ro, seeds.channel_map(spark), seeds.fee_rules(spark))
    p = c._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in p
    phys = _plan(c)
    assert phys.count("BroadcastHashJoin") == 3
    # Every exchange is under a broadcast (seed dedup), none on the line path.
    assert "SortMergeJoin" not in phys


def test_sku_profit_single_aggregation_shuffle(spark):
    ro = raw_orders(spark, [order(1, [item(11, "A", 10)])])
    c = costing.costed_lines(ro, seeds.channel_map(spark), seeds.fee_rules(spark))
    p = marts.fct_sku_profit(c, staging.stg_catalog(raw_catalog(spark, [{"ProductID": "A"}])))
    p.collect()
    plan = p._jdf.queryExecution().optimizedPlan().toString()
    # orders are counted with the first-line flag, not a distinct aggregation
    assert "Expand" not in plan and "count(distinct" not in plan.lower()


def test_json_parsed_once_per_order(spark):
    ro = raw_orders(spark, [order(1, [item(11, "A", 10)])])
    c = costing.costed_lines(ro, seeds.channel_map(spark), seeds.fee_rules(spark))
    assert "from_json(" not in _plan(c)   # landed documents are VARIANT: no text parsing


def test_hot_sku_is_pre_aggregated_per_task(spark):
    # one SKU carries a third of all lines
    docs = [order(i, [item(i * 10 + 1, "HOT", 3), item(i * 10 + 2, f"S{i % 7}", 2),
                      item(i * 10 + 3, f"T{i % 11}", 1)]) for i in range(1, 301)]
    ro = raw_orders(spark, docs).repartition(6)
    c = costing.costed_lines(ro, seeds.channel_map(spark), seeds.fee_rules(spark))
    p = marts.fct_sku_profit(c, staging.stg_catalog(raw_catalog(spark, [])))
    got = {r["sku"]: r for r in p.collect()}
    assert got["HOT"]["sales"] == 300 and got["HOT"]["orders"] == 300
    assert str(got["HOT"]["gross_revenue"]) == "900.00"
    plan = _plan(p)
    # partial aggregation runs before every exchange of the mart
    assert "partial_sum" in plan and "partial_count" in plan
    assert "collect_list" not in plan and "collect_set" not in plan


def test_returns_are_landed_without_repeated_work(spark, tmp_path):
    line = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string")
    lines = [(9, 7, 1, 2, 1.0, 5.0, 0.0, "R", "F"), (9, 3, 1, 1, 1.0, 5.0, 0.0, "R", "F"), (9, 200, 1, 3, 1.0, 5.0, 0.0, "R", "F"),
             (9, 1, 1, 4, 1.0, 5.0, 0.0, "N", "F"), (6, 11, 1, 1, 1.0, 5.0, 0.0, "R", "F"), (6, 11, 1, 1, 1.0, 5.0, 0.0, "R", "F"),
             (8, None, 1, 1, 1.0, 5.0, 0.0, "R", "F"), (8, 5, 1, 1, 1.0, 5.0, 0.0, "R", "F")]
    spark.createDataFrame(lines, line).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(6,), (8,), (9,), (10,)], "o_orderkey long").selectExpr(
        "o_orderkey", "timestamp_ntz'1995-01-02 03:04:05' as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    payloads = testdata.return_payloads(spark, str(tmp_path))
    sent = {r.seq: json.loads(r.value)["answers"] for r in payloads.collect()}
    assert {o: a["10"].get("answer") for o, a in sent.items()} == {
        6: "  sku-11 ,  sku-11 , ", 8: "SKU-5", 9: "OLD-3,SKU7,SKU 200"}
    landed = inputs.build_raw_returns(spark, str(tmp_path))
    assert {r.submission_id: str(r.processing_cost) for r in landed.collect()} == {"S6": "10.50", "S8": "13.00", "S9": "1009.25"}
    # An amount is read once, and lines are shuffled without the text that part keys give.
    assert landed._jdf.queryExecution().optimizedPlan().toString().count("$.answers['123'].answer") == 1
    plan = _plan(landed)
    assert "partial_collect_list" in plan and all("OLD-" not in x for x in plan.split("\n") if "partial_collect_list" in x)
