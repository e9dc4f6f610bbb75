"""API-shaped JSON payloads derived from the TPC-H-like test tables.

The production input of this package is landed JSON from three APIs
(orders with their lines, catalog products, return-form submissions).  The
test tables are relational, so this module turns them into payloads of the
same shape with Spark (one JSON document per order / product /
submission).  Every rule here is deterministic and is mirrored in SQL by
``marginlib.plans.oracle`` so results can be checked against DuckDB.

Rules (p = part key, o = order key):
  order  ID=o, CreatedOn=o_orderdate, GrandTotal=o_totalprice,
         StatusCode F/O/P -> 3/2/1, OrderSource by o % 13 (one code is
         unmapped), CompanyID '195' when o_custkey % 3 = 0 else '100',
         FinalShippingFee NULL when o % 11 = 0 else o % 20 + 0.99,
         ShippingTotal o % 15
  line   ID=o*100+position (lines sorted by part, supplier, line number,
         quantity, price), ProductID 'SKU-p', ShadowOf 'SKU-(p-4)' when
         p % 5 = 4, SitePrice NULL when p % 10 = 9 else retail + 1500,
         LineTotal 0 for o % 97 = 0 else price*(1-discount),
         AverageCost NULL when p % 17 = 0 else 40% of retail,
         FinalValueFee 12% of price, refunds on returned+final lines,
         BundleItems non-empty when p % 50 = 0
  catalog one product per part (+ an ambiguous twin 'SKU.p' when
         p % 100 = 0); id under 'Sku' instead of 'ProductID' when p % 29 = 0
  returns one submission per order with returned lines; SKUs typed in five
         styles by p % 5 ('SKU p' when p % 100 = 0 so it stays unmatched)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Load time stamped on every landed fixture row, and the cost-watch date.
FIXTURE_NOW = "2001-08-02 06:00:00"
AS_OF = "2001-08-01"

# The order-source code assigned to o_orderkey % 13 (999 is
# deliberately absent from the channel map).
ORDER_SOURCE_BY_MOD13 = [4, 20, 6, 72, 50, 79, 42, 1, 22, 0, 62, 999, 6]
# Return-form answer vocabularies, indexed by order key.
RETURN_CHANNELS = ["Amazon", "eBay", "Website", "Walmart"]
RETURN_REASONS = ["Defective", "Wrong item", "No longer needed"]
RETURN_DISPOSITIONS = ["New Open Box - A", "new", "Refurbished", "USED - good",
                       "Warranty claim", "parts only", "Other", None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec2(c) -> Column:
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def _sku(c: Column) -> Column:
    return F.concat(F.lit("SKU-"), c.cast("string"))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _pick(values: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-level fields of the order payload, one row per lineitem row."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    # Part grows with the data: a plain join, AQE broadcasts it only when
    # its measured size is under the threshold.
    # Lines travel to their order as they are: what is derived from them is wider.
    lines = li.join(part, li.l_partkey == part.p_partkey, "left").repartition("l_orderkey")
    p, o = F.col("l_partkey"), F.col("l_orderkey")
    zero_rev = (o % 97) == 0
    line_total = F.when(zero_rev, F.lit(0).cast("decimal(18,2)")).otherwise(
        F.round(_dec2("l_extendedprice") * (F.lit(1) - _dec2("l_discount")), 2).cast("decimal(18,2)"))
    return lines.select(
        o, "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        _sku(p).alias("ProductID"),
        F.when(p % 5 == 4, _sku(p - 4)).otherwise(F.lit("")).alias("ShadowOf"),
        F.col("p_name").alias("ProductName"),
        F.col("l_quantity").cast("decimal(12,2)").alias("Qty"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("QtyReturned"),
        F.when(p % 10 != 9, (_dec2("p_retailprice") + 1500).cast("decimal(18,2)")).alias("SitePrice"),
        line_total.alias("LineTotal"),
        F.when(p % 17 != 0, F.round(_dec2("p_retailprice") * F.lit("0.40").cast("decimal(3,2)"), 2)
               .cast("decimal(18,2)")).alias("AverageCost"),
        F.round(_dec2("l_extendedprice") * F.lit("0.12").cast("decimal(3,2)"), 2)
            .cast("decimal(18,2)").alias("FinalValueFee"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & ~zero_rev, line_total)
            .otherwise(F.lit(0).cast("decimal(18,2)")).alias("TotalRefunded"),
        F.when(p % 50 == 0, F.array(F.concat(F.lit("KIT-"), p.cast("string"))))
            .otherwise(F.array().cast("array<string>")).alias("BundleItems"),
    )


_ITEM_FIELDS = ["ProductID", "ShadowOf", "ProductName", "Qty", "QtyReturned", "SitePrice",
                "LineTotal", "AverageCost", "FinalValueFee", "TotalRefunded", "BundleItems"]
_LINE_ORDER = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]


def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per order: ``value`` (text) and ``seq`` (arrival)."""
    lines = order_lines(spark, sf_dir)
    # Lines of one order are gathered into its payload (an order is one API
    # record; its size is the order's line count, not the data size).
    per_order = (lines.groupBy("l_orderkey")
                 .agg(F.array_sort(F.collect_list(F.struct(*_LINE_ORDER, *_ITEM_FIELDS)))
                      .alias("lines")))
    items = F.transform(
        "lines",
        lambda x, i: F.struct(
            (F.col("o_orderkey") * 100 + i + 1).alias("ID"),
            *[x[f].alias(f) for f in _ITEM_FIELDS]))
    orders = table(spark, sf_dir, "orders")
    o = F.col("o_orderkey")
    payload = F.struct(
        o.alias("ID"),
        F.concat(F.lit("MK-"), o.cast("string")).alias("OrderSourceOrderID"),
        _iso(F.col("o_orderdate")).alias("CreatedOn"),
        _iso(F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")).alias("LastUpdated"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("GrandTotal"),
        _pick(ORDER_SOURCE_BY_MOD13, o % 13).alias("OrderSource"),
        F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "O", 2)
            .when(F.col("o_orderstatus") == "P", 1).alias("StatusCode"),
        F.when(F.col("o_custkey") % 3 == 0, F.lit("195")).otherwise(F.lit("100")).alias("CompanyID"),
        F.concat(F.lit("Company "), F.when(F.col("o_custkey") % 3 == 0, F.lit("195"))
                 .otherwise(F.lit("100"))).alias("CompanyName"),
        F.concat(F.lit("store/orders/"), o.cast("string")).alias("OrderSourceUrl"),
        (o % 15).alias("ShippingTotal"),
        F.when(o % 11 != 0, ((o % 20).cast("decimal(12,2)") + F.lit("0.99").cast("decimal(3,2)"))
               .cast("decimal(12,2)")).alias("FinalShippingFee"),
        F.when(F.col("lines").isNotNull(), items).alias("Items"),
    )
    return (orders.join(per_order, o == per_order.l_orderkey, "left")
            .select(F.to_json(payload).alias("value"), o.alias("seq")))


def catalog_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per catalog product (plus ambiguous twins)."""
    part = table(spark, sf_dir, "part")
    p = F.col("p_partkey")

    def doc(pid: Column, shadow: Column, name: Column) -> Column:
        return F.to_json(F.struct(
            F.when(p % 29 != 0, pid).alias("ProductID"),
            F.when(p % 29 == 0, pid).alias("Sku"),
            name.alias("ProductName"),
            shadow.alias("ShadowOf"),
            F.when(p % 13 == 0, F.lit(None).cast("string"))
             .when(p % 7 == 0, F.lit("Inactive")).otherwise(F.lit("Active")).alias("ActiveStatus"),
            (p % 11 == 0).alias("IsEndOfLife"),
            (p % 50 == 0).alias("IsKit"),
            (_dec2("p_retailprice") + 1500).cast("decimal(18,2)").alias("SitePrice"),
            F.round(_dec2("p_retailprice") * F.lit("0.40").cast("decimal(3,2)"), 2)
                .cast("decimal(18,2)").alias("AverageCost"),
            F.when(p % 6 == 0, F.lit(0).cast("decimal(18,2)"))
             .otherwise(F.round(_dec2("p_retailprice") * F.lit("0.45").cast("decimal(3,2)"), 2)
                        .cast("decimal(18,2)")).alias("LastCost"),
            F.col("p_brand").alias("BrandName"),
            F.col("p_type").alias("ProductType"),
            F.col("p_size").alias("WeightLbs"),
        ))

    main = part.select(
        doc(_sku(p), F.when(p % 5 == 4, _sku(p - 4)).otherwise(F.lit("")), F.col("p_name")).alias("value"),
        (p * 2).alias("seq"))
    twins = part.where(p % 100 == 0).select(
        doc(F.concat(F.lit("SKU."), p.cast("string")), F.lit(""),
            F.concat(F.col("p_name"), F.lit(" (twin)"))).alias("value"),
        (p * 2 + 1).alias("seq"))
    return main.unionByName(twins)


def _typed_sku(p: Column) -> Column:
    """How a person typed the SKU of part p on the return form."""
    ps = p.cast("string")
    return (F.when(p % 100 == 0, F.concat(F.lit("SKU "), ps))
             .when(p % 5 == 0, F.concat(F.lit("SKU-"), ps))
             .when(p % 5 == 1, F.concat(F.lit("  sku-"), ps, F.lit(" ")))
             .when(p % 5 == 2, F.concat(F.lit("SKU"), ps))
             .when(p % 5 == 3, F.concat(F.lit("OLD-"), ps))
             .otherwise(F.concat(F.lit("ZZZ "), ps)))


def return_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON submission per order that has returned lines."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    per_order = (li.groupBy("l_orderkey")
                 .agg(F.array_sort(F.collect_list(F.struct(*_LINE_ORDER))).alias("parts")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = per_order.join(orders, per_order.l_orderkey == orders.o_orderkey, "inner")
    o = F.col("l_orderkey")
    sku_raw = F.array_join(F.transform("parts", lambda x: _typed_sku(x["l_partkey"])), ",")
    sku_raw = F.when(o % 6 == 0, F.concat(sku_raw, F.lit(", "))).otherwise(sku_raw)
    cost_num = ((o % 37).cast("decimal(12,2)") * F.lit("1.25").cast("decimal(3,2)")
                + F.lit(3)).cast("decimal(12,2)")
    cost_txt = F.concat(F.lit("1,"), F.lpad((o % 1000).cast("string"), 3, "0"), F.lit(".25"))
    labor_txt = F.concat(F.lit("$"), (o % 7 + 5).cast("string"), F.lit(".50"))

    def ans(v: Column) -> Column:
        return F.struct(v.alias("answer"))

    answers = F.struct(
        ans(F.concat(F.lit("RMA-"), o.cast("string"))).alias("9"),
        ans(sku_raw).alias("10"),
        ans(_pick(RETURN_CHANNELS, o % 4)).alias("13"),
        ans(_pick(RETURN_REASONS, o % 3)).alias("15"),
        ans(_pick(RETURN_DISPOSITIONS, o % 8)).alias("18"),
        ans(labor_txt).alias("122"),
        ans(F.when(o % 9 == 0, cost_txt).otherwise(cost_num.cast("string"))).alias("123"),
    )
    # Numbers are sent as JSON numbers except the formatted ones.
    doc = F.to_json(F.struct(
        F.concat(F.lit("S"), o.cast("string")).alias("id"),
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 20 DAYS"), "yyyy-MM-dd HH:mm:ss")
            .alias("created_at"),
        answers.alias("answers")))
    return j.select(doc.alias("value"), o.alias("seq"))


def test_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias table for tests: 'OLD-p' -> 'SKU-p' for odd p with p % 5 = 3."""
    p = F.col("p_partkey")
    return (table(spark, sf_dir, "part").where((p % 5 == 3) & (p % 2 == 1))
            .select(F.concat(F.lit("OLD-"), p.cast("string")).alias("entered_sku"),
                    _sku(p).alias("canonical_sku")))
