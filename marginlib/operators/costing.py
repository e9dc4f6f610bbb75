"""Costing: attach channel and fee rules to every order line and compute
per-line profit (the intermediate table all marts read).

Two plans with the same result:

``costed_lines`` (default, shuffle-free).  Header and lines live in the
same landed document, so the order-level joins of the SQL model are not
needed: the order's revenue is folded over
its line array, the channel comes from two lookups into the
channel-map seed (company-specific first, then generic, then 'Other') and
the fee rule from a lookup into the fee seed, and only then are
the lines exploded.  With seeds up to ``seeds.BROADCAST_BYTES`` the whole thing is
one stage: scan -> project -> broadcast hash joins -> generate; larger ones are
joined by shuffle.

``costed_lines_joined``.  The literal form: lines LEFT JOIN resolved
orders (left join + row_number per order) LEFT JOIN per-order revenue
LEFT JOIN rules.  Kept as the readable reference and as a test partner;
it shuffles lines and orders on order_id.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import (ALLOC, ORDER_SUM, PRODUCT, RATIO, dec, qdiv,
                                 zero)
from ..sources import seeds
from ..functions.coerce import nullif_blank
from .staging import (STG_ITEMS_COLUMNS, header_of, item_columns, lines_of, status_kept, stg_order_items,
                      stg_orders)

COSTED_EXTRA = ["order_revenue", "created_on", "order_source", "company_id", "channel",
                "order_shipping_cost", "fee_method", "fee_pct", "flat_fee",
                "channel_pays_shipping", "allocated_shipping_cost", "allocated_flat_fee",
                "channel_fee", "list_discount", "ordered_at", "order_date", "gross_profit",
                "net_revenue", "contribution"]
INT_COSTED_COLUMNS = STG_ITEMS_COLUMNS + COSTED_EXTRA
# Helper column carried by the shuffle-free plan: True on the first line of
# each SKU within its order, so marts count distinct orders per SKU with a
# plain sum instead of a distinct aggregation (one shuffle instead of two).
FIRST_FLAG = "sku_first_in_order"


def _allocate(amount: Column, ratio: Column) -> Column:
    """amount * revenue share, exact, at 12 decimals."""
    return (F.coalesce(amount, zero()).cast(dec(18, 4)) * ratio.cast(dec(19, 12))).cast(ALLOC)


def finish_costing(df: DataFrame) -> DataFrame:
    """F1-F7 on a frame that has the line, order and rule columns."""
    r = F.col("order_revenue")
    no_rev = F.coalesce(r, zero(ORDER_SUM)) == 0
    ratio = qdiv(F.col("revenue"), r, in_type=dec(18, 4), out_type=RATIO)
    m = F.col("fee_method")
    alloc_ship = F.when(no_rev, zero(ALLOC)).otherwise(_allocate(F.col("order_shipping_cost"), ratio))
    alloc_flat = F.when(no_rev, zero(ALLOC)).otherwise(_allocate(F.col("flat_fee"), ratio))
    df = df.withColumns({"allocated_shipping_cost": alloc_ship, "allocated_flat_fee": alloc_flat})
    channel_fee = (F.when(m == seeds.FROM_ACTUALS, F.col("marketplace_fee"))
                   .when(m == seeds.COMPUTED_PCT_FLAT,
                         F.col("revenue") * F.col("fee_pct") + F.col("allocated_flat_fee"))
                   .otherwise(zero())).cast(ALLOC)
    list_discount = (F.when(m == seeds.WHOLESALE_NONE,
                            F.greatest(F.col("unit_price") * F.col("qty") - F.col("revenue"), zero()))
                     .otherwise(zero())).cast(PRODUCT)
    df = df.withColumns({"channel_fee": channel_fee, "list_discount": list_discount})
    net = F.col("revenue") - F.col("refunds")
    return df.withColumns({
        "ordered_at": F.col("created_on"),
        "order_date": F.to_date("created_on"),
        "gross_profit": F.col("revenue") - F.col("cogs"),
        "net_revenue": net,
        "contribution": net - F.col("cogs") - F.col("channel_fee") - F.col("allocated_shipping_cost"),
    })


def _first_flags(items: Column) -> Column:
    """For each typed line whether it is the first of its canonical SKU in the array.

    By sorting (SKU, place) and back: work grows with n log n lines of an order.
    """
    def key(f: Column, i: Column) -> Column:
        return F.struct(F.coalesce(nullif_blank(f["ShadowOf"]), f["ProductID"]).alias("s"), i.alias("i"))

    def flags(sorted_: Column) -> Column:
        def flag(x: Column, j: Column) -> Column:
            same = F.get(sorted_, j - 1)["s"].eqNullSafe(x["s"]) & (j > 0)
            return F.struct(x["i"].alias("i"), (~same).alias("first"))
        return F.transform(sorted_, flag)

    # An array of one element binds the sorted lines once.
    marked = F.get(F.transform(F.array(F.sort_array(F.transform(items, key))), flags), F.lit(0))
    return F.transform(F.sort_array(marked), lambda x: x["first"])


def costed_lines(raw_orders: DataFrame, channel_map: DataFrame, fee_rules: DataFrame,
                 excluded_status_codes: Iterable[int] = (),
                 drop_excluded_lines: bool = False) -> DataFrame:
    """int_order_items_costed, shuffle-free (plus the FIRST_FLAG column).

    By default lines of orders removed by the status filter are kept, with
    NULL order attributes and channel and no shipping or fee, exactly as
    the SQL model's left join to the filtered orders leaves them.  With
    ``drop_excluded_lines=True`` those lines are removed instead (what the
    project's documentation says the filter is for).

    Per order only the revenue is folded and the first line of each SKU
    flagged before the explode; all line arithmetic runs after it, inside
    whole-stage codegen.
    """
    specific, generic = map(seeds.small, seeds.prepared_channel_lookups(channel_map))
    rules = seeds.small(seeds.prepared_fee_rules(fee_rules))
    o = raw_orders.select(
        "order_id", "created_on", "order_source",
        status_kept(excluded_status_codes).alias("kept"),
        header_of(raw_orders)["company_id"].alias("doc_company_id"),
        header_of(raw_orders)["order_shipping_cost"].alias("doc_shipping"),
        lines_of(raw_orders).alias("items"))
    if drop_excluded_lines:
        o = o.where(F.col("kept"))
    o = o.withColumns({
        "order_revenue": F.aggregate(
            "items", zero(ORDER_SUM),
            lambda acc, x: (acc + F.coalesce(x["LineTotal"], zero())).cast(ORDER_SUM)),
        "lines": F.arrays_zip(F.col("items").alias("f"), _first_flags(F.col("items")).alias("first")),
    })
    o = (o.join(specific,
                (o.order_source == specific.order_source) & (o.doc_company_id == specific.company_id),
                "left")
          .drop(specific.order_source, specific.company_id)
          .join(generic, "order_source", "left"))
    kept = F.col("kept")
    o = o.select(
        "order_id", "lines", "order_revenue",
        F.when(kept, F.col("created_on")).alias("created_on"),
        F.when(kept, F.col("order_source")).alias("order_source"),
        F.when(kept, F.col("doc_company_id")).alias("company_id"),
        F.when(kept, F.coalesce("specific_channel", "generic_channel", F.lit(seeds.DEFAULT_CHANNEL)))
            .alias("channel"),
        F.when(kept, F.col("doc_shipping")).alias("order_shipping_cost"))
    o = o.join(rules, "channel", "left")
    order_cols = [c for c in COSTED_EXTRA if c in o.columns]
    # The outer variant plus a filter on the generated position keeps the
    # optimizer from inferring a non-empty-array filter on the scan side.
    lines = (o.select("order_id", *order_cols, F.posexplode_outer("lines").alias("pos", "line"))
              .where(F.col("pos").isNotNull()))
    lines = lines.select("order_id", *item_columns(F.col("line.f")), *order_cols, F.col("line.first").alias(FIRST_FLAG))
    return finish_costing(lines).select(*INT_COSTED_COLUMNS, FIRST_FLAG)


def order_channel(stg_orders_df: DataFrame, channel_map: DataFrame) -> DataFrame:
    """J4 + W1 + P10: one channel per order; the company-specific mapping
    beats the generic one, no mapping gives 'Other'."""
    m = channel_map.select(
        F.col("order_source").alias("m_order_source"),
        F.when(F.trim("company_id") != "", F.trim("company_id")).alias("m_company_id"),
        F.col("channel").alias("m_channel"))
    o = stg_orders_df.select("order_id", "created_on", "order_shipping_cost", "order_source",
                             "company_id")
    j = o.join(seeds.small(m),
               (m.m_order_source == o.order_source)
               & (m.m_company_id.isNull() | (m.m_company_id == o.company_id)),
               "left")
    # A key that the map lists twice has its smallest channel, as in the lookups.
    w = Window.partitionBy("order_id").orderBy(F.col("m_company_id").isNotNull().desc(), "m_channel")
    return (j.withColumn("rn", F.row_number().over(w))
             .where(F.col("rn") == 1)
             .select("order_id", "created_on", "order_shipping_cost", "order_source", "company_id",
                     F.coalesce("m_channel", F.lit(seeds.DEFAULT_CHANNEL)).alias("channel")))


def order_revenue(items: DataFrame) -> DataFrame:
    """A1: revenue per order."""
    return items.groupBy("order_id").agg(F.sum("revenue").cast(ORDER_SUM).alias("order_revenue"))


def costed_lines_joined(raw_orders: DataFrame, channel_map: DataFrame, fee_rules: DataFrame,
                        excluded_status_codes: Iterable[int] = ()) -> DataFrame:
    """int_order_items_costed as a chain of left joins (reference form)."""
    items = stg_order_items(raw_orders)
    resolved = order_channel(stg_orders(raw_orders, excluded_status_codes), channel_map)
    rules = seeds.prepared_fee_rules(fee_rules)
    j = (items.join(resolved, "order_id", "left")
              .join(order_revenue(items), "order_id", "left")
              .join(seeds.small(rules), "channel", "left"))
    return finish_costing(j).select(*INT_COSTED_COLUMNS)
