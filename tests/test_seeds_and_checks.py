import pytest
from pyspark.sql import functions as F

from marginlib.operators import checks, costing
from marginlib.sources import seeds

from tests.helpers import item, order, raw_orders, rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_seed_over_the_bound_is_not_broadcast(spark, tmp_path, monkeypatch):
    path = tmp_path / "map.csv"
    path.write_text("order_source,company_id,channel\n" + "".join(f"{k},,C{k}\n" for k in range(2000)))
    ro = raw_orders(spark, [order(k, [item(k, "A", 5)], source=k) for k in range(1, 4)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = costing.costed_lines(ro, seeds.channel_map(spark, str(path)), seeds.fee_rules(spark))
        assert "BroadcastHashJoin" in plan(small)
        table = seeds.channel_map(spark, str(path))
        assert "broadcast" in seeds.small(table)._jdf.logicalPlan().toString().lower()
        assert "broadcast" not in seeds.small(table, 1000)._jdf.logicalPlan().toString().lower()
        decide = seeds.small
        monkeypatch.setattr(seeds, "small", lambda df: decide(df, 1))
        large = costing.costed_lines(ro, seeds.channel_map(spark, str(path)), seeds.fee_rules(spark))
        assert "Broadcast" not in plan(large) and "SortMergeJoin" in plan(large)
        assert rows(small, "order_id", "channel") == rows(large, "order_id", "channel") == [(1, "C1"), (2, "C2"), (3, "C3")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_default_seeds_are_broadcast(spark):
    for seed, n in ((seeds.channel_map(spark), len(seeds.CHANNEL_MAP_ROWS)), (seeds.fee_rules(spark), len(seeds.FEE_RULES_ROWS))):
        assert "broadcast" in seeds.small(seed)._jdf.logicalPlan().toString().lower()
        assert seed.count() == n
    assert {tuple(r) for r in seeds.channel_map(spark).collect()} == set(seeds.CHANNEL_MAP_ROWS)
    ro = raw_orders(spark, [order(1, [item(1, "A", 5)])])
    costed = costing.costed_lines(ro, seeds.channel_map(spark), seeds.fee_rules(spark))
    # Orders are not shuffled by source or channel.
    assert "SortMergeJoin" not in plan(costed) and "Exchange hashpartitioning" not in plan(costed)


def test_repeated_seed_rows_give_one_result(spark):
    ro = raw_orders(spark, [order(1, [item(1, "A", 5), item(2, "B", 6)], source=4), order(2, [item(3, "A", 5)], source=6, company="195")])
    twice = spark.createDataFrame([(4, None, "Zeta"), (4, None, "Amazon"), (6, "195", "Target"), (6, "195", "Lowe's")],
                                  seeds.CHANNEL_MAP_SCHEMA)
    rules = seeds.fee_rules(spark).union(seeds.fee_rules(spark).withColumn("fee_method", F.lit("wholesale_none")))
    columns = ["order_item_id", "channel", "fee_method", "contribution"]
    one = rows(costing.costed_lines(ro, twice, rules), *columns)
    assert one == rows(costing.costed_lines_joined(ro, twice, rules), *columns)
    assert [r[:2] for r in one] == [(1, "Amazon"), (2, "Amazon"), (3, "Lowe's")]


def test_checks_read_each_model_once(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (2, "b"), (2, "b")], "k long, s string").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    tests = [("unique", "t", t, "k"), ("not_null", "t", t, "k"), ("not_null", "t", t, "s"), ("unique", "t", t, "s"),
             ("unique", "u", spark.range(5).toDF("x"), "x")]
    out = checks.run_checks(tests)
    assert plan(out).count("FileScan") <= 2         # the plan may be shown twice (initial and final)
    assert rows(out, "check", "model", "column", "failures") == sorted([
        ("unique", "t", "k", 2), ("not_null", "t", "k", 1), ("not_null", "t", "s", 1), ("unique", "t", "s", 1),
        ("unique", "u", "x", 0)], key=repr)
    with pytest.raises(ValueError):
        checks.run_checks([("other", "t", t, "k")])
