"""Costing and marts on hand-made orders: one quirk per test."""
from decimal import Decimal as D

from pyspark.sql import functions as F

from helpers import item, order, raw_catalog, raw_orders, rows
from marginlib.operators import costing, marts, staging
from marginlib.sources import seeds


def costed(spark, docs, excluded=(), joined=False):
    fn = costing.costed_lines_joined if joined else costing.costed_lines
    return fn(raw_orders(spark, docs), seeds.channel_map(spark), seeds.fee_rules(spark), excluded)


def test_allocation_and_fees(spark):
    docs = [order(1, [item(11, "A", 30, qty=2, cost=5, fee=3), item(12, "B", 10, fee=1)],
                  source=4, ship=8)]
    c = costed(spark, docs)
    got = {r["order_item_id"]: r for r in c.collect()}
    assert got[11]["channel"] == "Amazon" and got[11]["fee_method"] == "from_actuals"
    assert got[11]["allocated_shipping_cost"] == D("6.000000000000")
    assert got[12]["allocated_shipping_cost"] == D("2.000000000000")
    assert got[11]["channel_fee"] == D("3")
    # contribution = 30 - 0 refunds - 10 cogs - 3 fee - 6 shipping
    assert got[11]["contribution"] == D("11")
    assert got[11]["cogs"] == D("10")


def test_website_pct_plus_flat_fee(spark):
    docs = [order(1, [item(11, "A", 75), item(12, "B", 25)], source=6, company="100", ship=0)]
    got = {r["order_item_id"]: r for r in costed(spark, docs).collect()}
    assert got[11]["channel"] == "Website"
    # 75 * 0.024 + 0.30 * 0.75
    assert got[11]["channel_fee"] == D("2.025")
    assert got[12]["channel_fee"] == D("0.675")


def test_company_specific_channel_beats_generic(spark):
    docs = [order(1, [item(11, "A", 10)], source=6, company="195"),
            order(2, [item(21, "A", 10)], source=6, company="100"),
            order(3, [item(31, "A", 10)], source=6, company=" 195")]
    got = dict(rows(costed(spark, docs), "order_id", "channel"))
    # seed side is trimmed, order side is not (Q16)
    assert got == {1: "Lowe's", 2: "Website", 3: "Website"}


def test_unmapped_source_is_other(spark):
    got = rows(costed(spark, [order(1, [item(11, "A", 10)], source=999)]), "channel", "fee_method",
               "channel_fee")
    assert got == [("Other", "none", D(0))]


def test_excluded_orders_keep_lines(spark):
    docs = [order(1, [item(11, "A", 10, fee=2)], status=3, ship=5),
            order(2, [item(21, "A", 10, fee=2)], status=2, ship=5)]
    got = {r["order_id"]: r for r in costed(spark, docs, excluded=[3]).collect()}
    assert got[1]["channel"] is None and got[1]["ordered_at"] is None
    assert got[1]["allocated_shipping_cost"] == 0 and got[1]["channel_fee"] == 0
    assert got[1]["revenue"] == D(10)
    assert got[2]["channel"] == "Amazon" and got[2]["allocated_shipping_cost"] == D(5)


def test_zero_revenue_order_allocates_nothing(spark):
    got = rows(costed(spark, [order(1, [item(11, "A", 0), item(12, "B", 0)], ship=9)]),
               "allocated_shipping_cost")
    assert got == [(D(0),), (D(0),)]


def test_items_not_an_array_and_bundle_null(spark):
    docs = [order(1, {"ID": 5}), order(2, None), order(3, "x"),
            order(4, [item(41, "A", 10, bundle=None), item(42, "B", 10, bundle=[]),
                      item(43, "C", 10, bundle=["k"])])]
    docs[3]["Items"][0]["BundleItems"] = None
    items = staging.stg_order_items(raw_orders(spark, docs))
    assert rows(items, "order_item_id", "is_bundle") == [(41, False), (42, False), (43, True)]


def test_malformed_number_is_null(spark):
    docs = [order(1, [item(11, "A", "12,x", qty="abc", cost="$")])]
    r = staging.stg_order_items(raw_orders(spark, docs)).collect()[0]
    assert r["revenue"] == 0 and r["qty"] == 0 and r["unit_cost"] is None and r["cogs"] == 0


def test_shadow_rolls_into_parent(spark):
    docs = [order(1, [item(11, "A-RED", 10, shadow="A"), item(12, "A", 5), item(13, "B", 1)])]
    c = costed(spark, docs)
    assert rows(c, "order_item_id", "sku", "parent_sku") == [
        (11, "A", "A"), (12, "A", None), (13, "B", None)]
    p = marts.fct_sku_profit(c, staging.stg_catalog(raw_catalog(spark, [])))
    got = {r["sku"]: r for r in p.collect()}
    assert got["A"]["sales"] == 2 and got["A"]["orders"] == 1


def test_two_costing_plans_agree(spark):
    docs = [order(1, [item(11, "A", 10, cost=2), item(12, "A", 7, shadow="Z")], source=6,
                  company="195", ship=3),
            order(2, [item(21, "B", "1.005", qty=3, price=4)], source=22, ship=None, status=3),
            order(3, [item(31, "C", 10)], source=999),
            order(4, [])]
    for excl in ([], [3]):
        a = costed(spark, docs, excl).drop(costing.FIRST_FLAG)
        b = costed(spark, docs, excl, joined=True)
        assert rows(a) == rows(b)


def test_orders_count_flag_equals_distinct(spark):
    docs = [order(1, [item(11, "A", 1), item(12, "A", 2), item(13, None, 1), item(14, None, 1)]),
            order(2, [item(21, "A", 1), item(22, "B", 1)])]
    c = costed(spark, docs)
    via_flag = rows(marts.fct_sku_profit(c, staging.stg_catalog(raw_catalog(spark, []))),
                    "sku", "orders")
    c2 = c.drop(costing.FIRST_FLAG)
    via_distinct = rows(marts.fct_sku_profit(c2, staging.stg_catalog(raw_catalog(spark, []))),
                        "sku", "orders")
    assert via_flag == via_distinct == [("A", 2), ("B", 1), (None, 1)]


def test_sku_profit_divides_rounded_values(spark):
    # contribution 1/3 rounds to 0.33; margin uses the rounded 0.33 / 1.00
    docs = [order(1, [item(11, "A", "1.00", cost="0.666666", qty=1)], source=0, ship=0)]
    p = marts.fct_sku_profit(costed(spark, docs), staging.stg_catalog(raw_catalog(spark, [])))
    r = p.collect()[0]
    assert r["contribution"] == D("0.33") and r["contribution_margin_pct"] == D("0.3300")


def test_monthly_divides_unrounded_sums(spark):
    docs = [order(1, [item(11, "A", "1.00", cost="0.666666")], source=0, ship=0)]
    r = marts.fct_sku_profit_monthly(costed(spark, docs)).collect()[0]
    assert r["contribution_margin_pct"] == D("0.3333")
    assert r["sku_month"] == "A|2024-08"


def test_avg_shipping_ignores_zero_lines(spark):
    docs = [order(1, [item(11, "A", 10)], ship=4), order(2, [item(21, "A", 10)], ship=0)]
    r = marts.fct_sku_profit(costed(spark, docs), staging.stg_catalog(raw_catalog(spark, []))) \
        .collect()[0]
    assert r["avg_shipping_cost"] == D("4.00") and r["shipping_cost"] == D("4.00")


def test_null_group_keys_stay(spark):
    docs = [order(1, [item(11, "A", 10)], status=3)]
    c = costed(spark, docs, excluded=[3])
    assert rows(marts.fct_sku_channel(c), "sku_channel", "channel") == [(None, None)]
    assert rows(marts.fct_sku_profit_monthly(c), "sku_month", "month") == [(None, None)]


def test_cost_watch_window_and_flags(spark):
    cat = staging.stg_catalog(raw_catalog(spark, [
        {"ProductID": "A", "LastCost": 6, "AverageCost": 4, "SitePrice": 20, "ActiveStatus": "Active"},
        {"ProductID": "B", "LastCost": 0, "AverageCost": 3, "SitePrice": 9}]))
    docs = [order(1, [item(11, "A", 10, cost=5)], source=0, ship=0, created="2024-08-01T00:00:00Z"),
            order(2, [item(21, "B", 10, cost=3)], source=0, ship=0, created="2024-01-01T00:00:00Z")]
    cw = marts.fct_sku_cost_watch(costed(spark, docs), cat, "2024-09-01", 90)
    got = {r["sku"]: r for r in cw.collect()}
    assert set(got) == {"A"}
    a = got["A"]
    assert a["current_unit_cost"] == D("6.00") and a["at_sale_unit_cost"] == D("5.00")
    assert a["cost_change_pct"] == D("0.2000") and a["cost_up_over_10pct"] is True
    assert a["contribution_per_unit_at_current_cost"] == D("4.00")
    assert a["sells_at_a_loss_now"] is False and a["is_active"] is True


def test_shipping_allocation_invariant(spark):
    docs = [order(i, [item(i * 10 + k, f"S{k}", f"{k * 3 + 1}.37") for k in range(1, 4)], ship=7.77)
            for i in range(1, 30)]
    c = costed(spark, docs)
    per = c.groupBy("order_id").agg(F.sum("allocated_shipping_cost").alias("s")).collect()
    for r in per:
        assert abs(r["s"] - D("7.77")) < D("0.000000001")


def test_mart_invariants_on_test_data(spark):
    from marginlib.plans.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    c = QUERIES["int_order_items_costed"](spark, sf)
    n_lines = c.count()
    p = QUERIES["fct_sku_profit"](spark, sf)
    m = QUERIES["fct_sku_profit_monthly"](spark, sf)
    ch = QUERIES["fct_sku_channel"](spark, sf)
    assert p.agg(F.sum("sales")).first()[0] == n_lines
    assert m.agg(F.sum("sales")).first()[0] == n_lines
    assert ch.agg(F.sum("sales")).first()[0] == n_lines
    # monthly and SKU totals agree up to per-row rounding (one cent per row)
    tot_p = p.agg(F.sum("contribution")).first()[0]
    tot_m = m.agg(F.sum("contribution")).first()[0]
    assert abs(tot_p - tot_m) <= D("0.005") * (m.count() + p.count())
    units_p = p.agg(F.sum("units_sold")).first()[0]
    units_m = m.agg(F.sum("units_sold")).first()[0]
    assert units_p == units_m


def test_malformed_numbers_are_counted(spark):
    docs = [order(1, [item(11, "A", "12,x", qty="abc", cost="$"), item(12, "B", 3, qty=None)])]
    docs[0]["Items"][1]["Qty"] = None          # JSON null is not malformed
    got = {r["column"]: r["failures"]
           for r in staging.malformed_line_numbers(raw_orders(spark, docs)).collect()}
    assert got["LineTotal"] == 1 and got["Qty"] == 1 and got["AverageCost"] == 1
    assert got["FinalValueFee"] == 0 and got["ID"] == 0


def test_wholesale_lines_still_bear_shipping(spark):
    # Home Depot pays shipping per the rules, but the flag is not used (Q5)
    docs = [order(1, [item(11, "A", 90, qty=1, price=100)], source=72, ship=6)]
    r = costed(spark, docs).collect()[0]
    assert r["channel"] == "Home Depot" and r["channel_pays_shipping"] is True
    assert r["allocated_shipping_cost"] == D(6) and r["list_discount"] == D(10)
    # list discount is analytical only: contribution = 90 - 0 - 0 - 0 - 6
    assert r["contribution"] == D(84)


def test_cost_watch_rounding_order(spark):
    # window contribution 10/3 per unit: per-unit actual uses the unrounded
    # total, the at-current-cost figures use already rounded inputs (Q8)
    cat = staging.stg_catalog(raw_catalog(spark, [{"ProductID": "A", "LastCost": "1.005"}]))
    docs = [order(1, [item(11, "A", "10.00", qty=3, cost="1.00")], source=0, ship=0,
                  created="2024-08-01T00:00:00Z")]
    r = marts.fct_sku_cost_watch(costed(spark, docs), cat, "2024-08-02", 90).collect()[0]
    assert r["contribution_window"] == D("7.00")
    assert r["contribution_per_unit_actual"] == D("2.33")      # 7 / 3
    assert r["avg_selling_price"] == D("3.33") and r["current_unit_cost"] == D("1.01")
    assert r["contribution_per_unit_at_current_cost"] == D("2.32")   # 3.33 - 1.01 - 0
    assert r["margin_pct_at_current_cost"] == D("0.6967")            # 2.32 / 3.33


def test_text_max_is_byte_order(spark):
    docs = [order(1, [item(11, "A", 1, name="apple")]), order(2, [item(21, "A", 1, name="Banana")])]
    p = marts.fct_sku_profit(costed(spark, docs), staging.stg_catalog(raw_catalog(spark, [])))
    assert p.collect()[0]["product_name"] == "apple"      # 'a' (0x61) > 'B' (0x42)
