"""Returns cleaning: split, cost share, disposition, tiered SKU matching."""
from decimal import Decimal as D

from pyspark.sql import functions as F

from helpers import raw_catalog, raw_returns, rows
from marginlib.operators import returns, staging


def sub(sid, skus, cost=None, disposition=None, created="2024-08-19 10:44:20"):
    ans = {"10": {"answer": skus}, "18": {"answer": disposition}}
    if cost is not None:
        ans["123"] = {"answer": cost}
    return {"id": sid, "created_at": created, "answers": ans}


def catalog(spark, items):
    return staging.stg_catalog(raw_catalog(spark, items))


def test_split_blank_parts_and_cost_share(spark):
    r = raw_returns(spark, [sub("1", "A, ,B,", cost="$10.00"), sub("2", "", cost=5),
                            sub("3", ", ,"), sub("4", "C", cost="1,000.01")])
    e = returns.exploded(r)
    assert rows(e, "submission_id", "sku_entered", "skus_in_submission", "processing_cost_alloc") == [
        ("1", "A", 2, D("5.00")), ("1", "B", 2, D("5.00")), ("4", "C", 1, D("1000.01"))]


def test_cost_share_rounds_without_redistribution(spark):
    e = returns.exploded(raw_returns(spark, [sub("1", "A,B,C", cost=10)]))
    assert {r["processing_cost_alloc"] for r in e.collect()} == {D("3.33")}


def test_disposition_categories(spark):
    cases = {"New Open Box": "open_box", "new": "new", "NEW - sealed": "new",
             "refurbished": "refurbished", "Used": "used", "warranty x": "warranty",
             "Parts only": "scrapped", "other": "unknown", None: "unknown"}
    r = raw_returns(spark, [sub(str(i), "A", disposition=d) for i, d in enumerate(cases)])
    got = dict(rows(r.select("disposition", returns.disposition_category(r.disposition).alias("c"))))
    assert got == cases


def test_match_tiers(spark):
    cat = catalog(spark, [
        {"ProductID": "SS7000Stainless"},
        {"ProductID": "AB-1"}, {"ProductID": "AB.1"},          # ambiguous normalized key
        {"ProductID": "K-2-RED", "ShadowOf": "K-2"},
        {"ProductID": "---"},                                  # punctuation only
    ])
    aliases = spark.createDataFrame([("old-9", "K-2"), (" ", "X")], "entered_sku string, canonical_sku string")
    r = raw_returns(spark, [sub("1", "ss7000_stainless, AB1, k-2-red, OLD-9 ,ab-1,zz"),
                            sub("2", "!!")])
    out = returns.stg_returns(r, cat, aliases)
    got = rows(out, "sku_entered", "sku", "sku_match_status")
    assert got == sorted([
        ("ss7000_stainless", "SS7000Stainless", "normalized"),
        ("AB1", "AB1", "unmatched"),
        ("k-2-red", "K-2", "exact"),
        ("OLD-9", "K-2", "alias"),
        ("ab-1", "AB-1", "exact"),
        ("zz", "zz", "unmatched"),
        ("!!", "---", "normalized"),
    ], key=repr)


def test_duplicate_sku_in_submission_repeats_line_id(spark):
    r = raw_returns(spark, [sub("1", "A,a", cost=4)])
    out = returns.stg_returns(r, catalog(spark, [{"ProductID": "A"}]),
                              spark.createDataFrame([], "entered_sku string, canonical_sku string"))
    got = rows(out, "return_line_id", "processing_cost", "skus_in_submission")
    assert got == [("1|a", D("2.00"), 2), ("1|a", D("2.00"), 2)]


def test_flags(spark):
    r = raw_returns(spark, [sub("1", "A", disposition="Warranty"), sub("2", "A", disposition="Used")])
    out = returns.stg_returns(r, catalog(spark, []),
                              spark.createDataFrame([], "entered_sku string, canonical_sku string"))
    got = rows(out, "submission_id", "is_warranty", "resells_as_new", "resells_as_sd", "is_scrapped")
    assert got == [("1", True, False, False, False), ("2", False, False, True, False)]


def test_hot_typed_sku_is_spread(spark):
    """A third of the lines with one SKU: all match, and no task holds twice the median."""
    n = 1_200
    r = raw_returns(spark, [sub(str(i), "HOT.1" if i % 3 == 0 else f"s-{i}") for i in range(n)])
    cat = catalog(spark, [{"ProductID": "hot-1"}, {"ProductID": "S-1"}])
    aliases = spark.createDataFrame([], "entered_sku string, canonical_sku string")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": "4"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = returns.stg_returns(r, cat, aliases)
        sizes = [x["count"] for x in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        status = {(x.sku_entered[:3], x.sku, x.sku_match_status) for x in out.collect() if x.sku_entered in ("HOT.1", "s-1", "s-2")}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert status == {("HOT", "hot-1", "normalized"), ("s-1", "S-1", "exact"), ("s-2", "s-2", "unmatched")}
    assert sum(sizes) == n and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_more_hot_skus_than_are_broadcast(spark, monkeypatch):
    """Heavy and light keys agree with a lookup of each line."""
    monkeypatch.setattr(returns, "HEAVY", 2)
    r = raw_returns(spark, [sub(str(i), f"k{i % 5}, K-{i % 5},zz") for i in range(40)])
    cat = catalog(spark, [{"ProductID": f"K{i}"} for i in range(4)])
    aliases = spark.createDataFrame([("zz", "K0")], "entered_sku string, canonical_sku string")
    got = {(x.sku_entered, x.sku, x.sku_match_status) for x in returns.stg_returns(r, cat, aliases).collect()}
    assert got == ({(f"k{i}", f"K{i}", "exact") for i in range(4)} | {(f"K-{i}", f"K{i}", "normalized") for i in range(4)}
                   | {("k4", "k4", "unmatched"), ("K-4", "K-4", "unmatched"), ("zz", "K0", "alias")})
